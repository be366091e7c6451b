"""Media columns as MPEG transport streams: program tables, continuity counters, elementary packets, timestamps and random-access points."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from orbitloom.llm.common import map_rows, table

PACKET, SYNC = 188, 0x47
PAT_PID, PMT_PID, ES_PID, PROGRAM, STREAM_TYPE, STREAM_ID = 0, 0x1000, 0x100, 1, 0x06, 0xBD
#: Payload bytes of an elementary packet, ticks of 90 kHz between two of them, and how many lie between random-access points.
UNIT, TICKS, ACCESS = 16384, 3600, 8
PADDING = 64


def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        c = n << 24
        for _ in range(8):
            c = (c << 1 ^ (0x04C11DB7 if c >> 31 else 0)) & 0xFFFFFFFF
        out.append(c)
    return out


CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = c << 8 & 0xFFFFFFFF ^ CRC[c >> 24 ^ b]
    return c


def section(table_id: int, number: int, body: bytes) -> bytes:
    """A table section: header, body and checksum."""
    head = bytes([table_id, 0xB0 | len(body) + 9 >> 8, len(body) + 9 & 0xFF]) + number.to_bytes(2, "big") + bytes([0xC1, 0, 0])
    return head + body + crc32_mpeg(head + body).to_bytes(4, "big")


def table_packet(pid: int, data: bytes) -> bytes:
    return (bytes([SYNC, 0x40 | pid >> 8, pid & 0xFF, 0x10, 0]) + data).ljust(PACKET, b"\xff")


PAT = table_packet(PAT_PID, section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big")))
PMT = table_packet(PMT_PID, section(2, PROGRAM, (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([STREAM_TYPE]) + (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00"))


def stamp(ticks: int) -> bytes:
    """A presentation timestamp of 33 bits with its marker bits."""
    return bytes([0x21 | ticks >> 29 & 0x0E, ticks >> 22 & 0xFF, 0x01 | ticks >> 14 & 0xFE, ticks >> 7 & 0xFF, 0x01 | ticks << 1 & 0xFE])


def unstamp(b: bytes) -> int:
    return (b[0] & 0x0E) << 29 | b[1] << 22 | (b[2] & 0xFE) << 14 | b[3] << 7 | b[4] >> 1


def clock(ticks: int) -> bytes:
    """A program clock reference; the extension of 27 MHz is 0."""
    return bytes([ticks >> 25 & 0xFF, ticks >> 17 & 0xFF, ticks >> 9 & 0xFF, ticks >> 1 & 0xFF, (ticks & 1) << 7 | 0x7E, 0])


def mux(payload: bytes) -> bytes:
    """A transport stream with one program of one private stream that carries the payload in elementary packets of at most UNIT bytes."""
    out, counter = [PAT, PMT], 0
    for k, at in enumerate(range(0, len(payload), UNIT)):
        part, ticks = payload[at : at + UNIT], k * TICKS % (1 << 33)
        pes = b"\x00\x00\x01" + bytes([STREAM_ID]) + (len(part) + 8).to_bytes(2, "big") + b"\x80\x80\x05" + stamp(ticks) + part
        head = bytes([7, 0x50]) + clock(ticks) if k % ACCESS == 0 else b""
        first = min(len(pes), PACKET - 4 - len(head))
        rest = len(pes) - first
        n = 1 + -(-rest // (PACKET - 4))
        packets = np.empty((n, PACKET), np.uint8)
        packets[:, 0], packets[:, 1], packets[:, 2] = SYNC, ES_PID >> 8, ES_PID & 0xFF
        packets[0, 1] |= 0x40
        packets[:, 3] = 0x10 | (counter + np.arange(n)) % 16
        counter += n
        whole = rest // (PACKET - 4)
        data = np.frombuffer(pes, np.uint8)
        packets[1 : 1 + whole, 4:] = data[first : first + whole * (PACKET - 4)].reshape(whole, PACKET - 4)
        for i, body, field in ((0, data[:first], head), *([(n - 1, data[first + whole * (PACKET - 4) :], b"")] if n > 1 + whole else [])):
            room = PACKET - 4 - len(body)  # the adaptation field fills what the body leaves
            if room:
                packets[i, 3] |= 0x20
                field = field or (b"\x00" if room == 1 else b"\x01\x00" if room == 2 else b"\x01\x00")[: max(1, room)]
                filled = bytearray(field.ljust(room, b"\xff"))
                filled[0] = room - 1
                packets[i, 4 : 4 + room] = np.frombuffer(bytes(filled), np.uint8)
            packets[i, 4 + room :] = body
        out.append(packets.tobytes())
    return b"".join(out)


class StreamError(ValueError):
    """The bytes aren't a transport stream that can be read."""


def sections(payload: bytes) -> Iterable[bytes]:
    """Whole sections with a right checksum after the pointer field of a packet."""
    at = 1 + payload[0] if payload else 0
    while at + 3 <= len(payload) and payload[at] != 0xFF:
        end = at + 3 + ((payload[at + 1] & 0x0F) << 8 | payload[at + 2])
        if end > len(payload) or crc32_mpeg(payload[at:end]):
            break
        yield payload[at:end]
        at = end


def demux(stream: bytes) -> dict:
    """Programs, streams, faults of continuity, and the elementary packets with their timestamps and random-access marks, from the stream's bytes alone."""
    if len(stream) % PACKET:
        raise StreamError("not whole packets")
    p = np.frombuffer(stream, np.uint8).reshape(-1, PACKET)
    if not (p[:, 0] == SYNC).all():
        raise StreamError("a packet without its sync byte")
    pid = (p[:, 1].astype(np.int32) & 0x1F) << 8 | p[:, 2]
    starts, control = p[:, 1] & 0x40 > 0, p[:, 3] >> 4 & 3
    begin = np.where(control & 2 > 0, 5 + p[:, 4].astype(np.int32), 4)
    begin = np.minimum(np.where(control & 1 > 0, begin, PACKET), PACKET)
    flags = np.where((control & 2 > 0) & (p[:, 4] > 0), p[:, 5], 0)
    programs, streams = {}, {}
    for i in np.flatnonzero((pid == PAT_PID) & starts):
        for s in sections(p[i, begin[i] :].tobytes()):
            for at in range(8, len(s) - 4, 4):
                if number := int.from_bytes(s[at : at + 2], "big"):
                    programs[number] = int.from_bytes(s[at + 2 : at + 4], "big") & 0x1FFF
    for number, table_pid in programs.items():
        for i in np.flatnonzero((pid == table_pid) & starts):
            for s in sections(p[i, begin[i] :].tobytes()):
                at = 12 + (int.from_bytes(s[10:12], "big") & 0x0FFF)
                while at + 5 <= len(s) - 4:
                    streams[int.from_bytes(s[at + 1 : at + 3], "big") & 0x1FFF] = (number, s[at])
                    at += 5 + (int.from_bytes(s[at + 3 : at + 5], "big") & 0x0FFF)
    faults, units = 0, []
    for es in sorted(streams):
        own = np.flatnonzero(pid == es)
        loaded = own[control[own] & 1 > 0]
        counters = p[loaded, 3] & 0x0F
        step = (counters[1:].astype(np.int32) - counters[:-1]) % 16
        repeated = np.r_[False, step == 0] & np.r_[False, (p[loaded][1:, 4:] == p[loaded][:-1, 4:]).all(axis=1)] if len(loaded) else np.zeros(0, bool)
        faults += int((((step != 1) & ~repeated[1:]) & (flags[loaded[1:]] & 0x80 == 0)).sum()) if len(loaded) else 0
        loaded = loaded[~repeated]
        lengths = PACKET - begin[loaded]
        body = p[loaded][np.arange(PACKET) >= begin[loaded][:, None]].tobytes()
        ends = np.cumsum(lengths)
        first = np.flatnonzero(starts[loaded])
        for j, i in enumerate(first):
            pes = body[int(ends[i] - lengths[i]) : int(ends[first[j + 1] - 1] if j + 1 < len(first) else ends[-1])]
            if pes[:3] != b"\x00\x00\x01" or len(pes) < 9:
                faults += 1
                continue
            size, at = int.from_bytes(pes[4:6], "big"), 9 + pes[8]
            end = 6 + size if size else len(pes)
            faults += end > len(pes)
            units.append({"pid": es, "pts": unstamp(pes[9:14]) if pes[7] & 0x80 else None, "random_access": bool(flags[loaded[i]] & 0x40), "packet": int(loaded[i]), "data": pes[at:end]})
    return {"packets": len(p), "programs": programs, "streams": streams, "faults": faults, "units": units}


def transport_streams(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns in keep, with n_bytes of the text in UTF-8 (null: empty) and `media`, a transport stream of these bytes followed by bytes 0 up to a positive multiple of 64."""

    def make() -> Callable[[tuple], Iterable[tuple]]:
        def row(values: tuple) -> Iterable[tuple]:
            data = (values[-1] or "").encode()
            yield *values[:-1], len(data), mux(data.ljust(max(1, -(-len(data) // PADDING)) * PADDING, b"\0"))

        return row

    kinds = dict(df.dtypes)
    return map_rows(df.select(*keep, text), make, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n_bytes long, media binary"]))


def elementary_packets(df: DataFrame, media: str, keep: list[str]) -> DataFrame:
    """The columns in keep, with what demux() reads from the media column: packets, programs, streams, faults of continuity, and units (pid, pts, random access, packet number, size) with their payload joined. A null or broken stream has null in all of them and its reason in `error`."""

    def make() -> Callable[[tuple], Iterable[tuple]]:
        def row(values: tuple) -> Iterable[tuple]:
            try:
                if values[-1] is None:
                    raise StreamError("null")
                d = demux(values[-1])
            except StreamError as e:
                yield *values[:-1], str(e), None, None, None, None, None, None
                return
            units = [{**{k: u[k] for k in ("pid", "pts", "random_access", "packet")}, "size": len(u["data"])} for u in d["units"]]
            yield *values[:-1], None, d["packets"], list(d["programs"].items()), [{"pid": k, "program": n, "type": kind} for k, (n, kind) in d["streams"].items()], d["faults"], units, b"".join(u["data"] for u in d["units"])

        return row

    kinds = dict(df.dtypes)
    return map_rows(df.select(*keep, media), make, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "error string, packets long, programs map<int, int>, streams array<struct<pid: int, program: int, type: int>>, faults long, units array<struct<pid: int, pts: long, random_access: boolean, packet: long, size: long>>, payload binary"]))


def op1_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts count as empty; equal texts give equal streams and features."""

    def make() -> Callable[[tuple], Iterable[tuple]]:
        def row(values: tuple) -> Iterable[tuple]:
            doc_id, n_bytes, media = values
            d = demux(media)
            payload = b"".join(u["data"] for u in d["units"])
            pts = [u["pts"] for u in d["units"]]
            access = [u["pts"] for u in d["units"] if u["random_access"]]
            feature = f"packets={d['packets']};programs={len(d['programs'])};streams={','.join(f'{k:#x}:{kind:#x}' for k, (_, kind) in sorted(d['streams'].items()))};faults={d['faults']};units={len(pts)};pts={pts[0]}-{pts[-1]};access={','.join(map(str, access))}"
            yield doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-PADDING:]), len(media), hashlib.sha256(media).hexdigest(), feature

        return row

    streams = transport_streams(table(spark, sf_dir, "documents"), "text", ["doc_id"])
    return map_rows(streams, make, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
