"""Formats, class lists and statistics that results depend on."""

import datetime

#: Optical bands in their fixed order, and their names in the second source, in the same order.
BANDS = ("B04", "B02", "B03", "B08", "B8A", "B05", "B06", "B07", "B11", "B12")
BAND_ALIASES = ("red", "blue", "green", "nir", "nir08", "rededge1", "rededge2", "rededge3", "swir16", "swir22")
#: Scene classes that count as invalid, and the class of water.
SCL_INVALID = (0, 1, 2, 3, 8, 9)
SCL_WATER = 6
#: Optical values from dates after this one carry an offset.
HARMONISATION_DATE = datetime.date(2022, 1, 25)
HARMONISATION_OFFSET = 1000
S2_MEAN = (1711.0938, 1308.8511, 1546.4543, 3010.1293, 3106.5083, 2068.3044, 2685.0845, 2931.5889, 2514.6928, 1899.4922)
S2_STD = (1926.1026, 1862.9751, 1803.1792, 1741.7837, 1677.4543, 1888.7862, 1736.3090, 1715.8104, 1514.5199, 1398.4779)
S1_MEAN = (5484.0407, 3003.7812)
S1_STD = (1871.2334, 1726.0670)
LATENT, SAMPLES, LEAST_VALID, BLOCK = 128, 40, 0, 1024
#: Per cent of a tile that a date must cover, share of valid scenes that makes water, day of year of a dummy radar row.
LEAST_COVERAGE, WATER_SHARE, DUMMY_DOY = 0.01, 0.8, 180
#: Channels of the cloud mask, as places in BANDS.
CLOUD_CHANNELS = (0, 2, 4)
