"""Registry of this subpackage's queries and of their DuckDB oracles."""

from orbitloom.llm.divergence import OP11_SQL, op11_source_divergence
from orbitloom.llm.licenses import op10_license_scan
from orbitloom.llm.mixing import op7_mixing
from orbitloom.llm.near_duplicates import OP3_SQL, op3_jaccard_join
from orbitloom.llm.neighbours import op5_neighbours
from orbitloom.llm.packing import op4_packing
from orbitloom.llm.personal_data import op8_personal_data
from orbitloom.llm.sharding import op2_sharding
from orbitloom.llm.spelling import OP12_SQL, op12_spelling_variants
from orbitloom.llm.token_counts import op9_token_counts
from orbitloom.llm.token_files import op13_token_files
from orbitloom.llm.toxicity import op6_toxicity
from orbitloom.llm.transport_stream import op1_transport_stream

QUERIES = {f.__name__: f for f in (op1_transport_stream, op2_sharding, op3_jaccard_join, op4_packing, op5_neighbours, op6_toxicity, op7_mixing, op8_personal_data, op9_token_counts, op10_license_scan, op11_source_divergence, op12_spelling_variants, op13_token_files)}
ORACLES: dict[str, str] = {"op3_jaccard_join": OP3_SQL, "op11_source_divergence": OP11_SQL, "op12_spelling_variants": OP12_SQL}
