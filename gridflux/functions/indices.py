"""Quality masks, reflectance and vegetation indices as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridflux.functions.semantics import clip, ieee_div

# Scale, offset and soil factor; bands, indices and sensors.
SCALE, OFFSET, SOIL = 0.0000275, -0.2, 0.5
BANDS = ("blue", "green", "red", "nir", "swir1", "swir2")
INDICES = ("ndvi", "evi", "kndvi", "nbr", "savi")
SENSOR_YEARS = {"L5": (1984, 2011), "L7": (1999, 2022), "L8": (2013, 2100), "L9": (2021, 2100)}
# Bits of QA_PIXEL (public Collection 2 definition): fill, dilated cloud, cirrus, cloud, shadow, snow.
FILL, DILATED, CIRRUS, CLOUD, SHADOW, SNOW = 1, 2, 4, 8, 16, 32
CIRRUS_SENSORS = ("L8", "L9")


def clear_mask(qa: Column, sensor: Column) -> Column:
    """No fill, dilated cloud, cloud, shadow or snow; no cirrus where the sensor
    has that flag (in others the bit says nothing)."""
    common = FILL | DILATED | CLOUD | SHADOW | SNOW
    bits = F.when(sensor.isin(*CIRRUS_SENSORS), F.lit(common | CIRRUS)).otherwise(F.lit(common))
    return qa.bitwiseAND(bits) == 0


def reflectance(number: Column, clear: Column) -> Column:
    """Surface reflectance of a scaled integer; null if not positive or not clear."""
    return F.when(clear & (number > 0), number * SCALE + OFFSET)


def ndvi(nir: Column, red: Column) -> Column:
    return clip(ieee_div(nir - red, nir + red), -1.0, 1.0)


def evi(nir: Column, red: Column, blue: Column) -> Column:
    return clip(ieee_div((nir - red) * 2.5, nir + red * 6.0 - blue * 7.5 + 1.0), -1.0, 1.0)


def kndvi(ndvi_value: Column) -> Column:
    """Of the clipped NDVI."""
    return F.tanh(ndvi_value * ndvi_value)


def nbr(nir: Column, swir2: Column) -> Column:
    return clip(ieee_div(nir - swir2, nir + swir2), -1.0, 1.0)


def savi(nir: Column, red: Column) -> Column:
    return clip(ieee_div((nir - red) * (1 + SOIL), nir + red + SOIL), -1.5, 1.5)


def with_clear(obs: DataFrame) -> DataFrame:
    return obs.withColumn("clear", clear_mask(F.col("qa"), F.col("sensor")))


def to_indices(obs: DataFrame) -> DataFrame:
    """Bands (``band_*``), indices, ``doy`` and ``year`` of observations with
    scaled bands, ``ts``, ``sensor`` and ``clear``; other columns stay."""
    rest = [c for c in obs.columns if c not in BANDS]
    bands = obs.select(*rest, *(reflectance(F.col(b), F.col("clear")).alias(f"band_{b}") for b in BANDS))
    nir, red, blue, swir2 = (F.col(f"band_{b}") for b in ("nir", "red", "blue", "swir2"))
    first = bands.withColumns({
        "ndvi": ndvi(nir, red), "evi": evi(nir, red, blue), "nbr": nbr(nir, swir2), "savi": savi(nir, red),
        "doy": F.dayofyear("ts"), "year": F.year("ts"),
    })
    return first.withColumn("kndvi", kndvi(F.col("ndvi")))
