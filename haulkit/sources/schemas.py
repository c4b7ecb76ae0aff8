"""Explicit schemas for the survey's CSV drops and products (no inference)."""

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType


def _s(*cols):
    return StructType([StructField(n, t, True) for n, t in cols])


S, I, L, D = StringType(), IntegerType(), LongType(), DoubleType()

CATCH = _s(("HAUL", L), ("HAUL_ID", S), ("RECORDING_DEVICE", S), ("ID", S), ("CRUISE", I), ("VESSEL", I),
           ("STATION", S), ("SPECIES_CODE", I), ("SPECIES_NAME", S), ("NUMBER_CRAB", I), ("WEIGHT", D))

SPECIMEN = _s(("HAUL", L), ("HAUL_ID", S), ("SPECIES_CODE", I), ("SEX", I), ("LENGTH", D), ("WIDTH", D),
              ("SHELL_CONDITION", I), ("EGG_COLOR", I), ("EGG_CONDITION", I), ("CLUTCH_SIZE", I),
              ("DISEASE_CODE", I), ("DISEASE_DORSAL", D), ("DISEASE_VENTRAL", D), ("DISEASE_LEGS", D),
              ("CHELA_HEIGHT", D), ("MERUS_LENGTH", D), ("COMMENTS", S), ("NOTES", S), ("STATION", S))

RAW_SAMPLE = _s(("HAUL_ID", S), ("CATCH_SAMPLE_ID", S), ("PARENT_SAMPLE_ID", S), ("MIX", S), ("SAMPLED_ALL", S),
                ("SPECIES_CODE", I), ("SPECIES_NAME", S), ("SEX", I), ("RECORDING_DEVICE", S), ("RECORDER", S))

RAW_SAMPLE_VALUES = _s(("HAUL_ID", S), ("CATCH_SAMPLE_VALUE_ID", S), ("CATCH_SAMPLE_ID", S), ("COUNT", I),
                       ("WEIGHT", D), ("KEEP", S), ("RECORDING_DEVICE", S), ("RECORDER", S))

RAW_FISH_VALUES = _s(("CATCH_SAMPLE_VALUE_ID", S), ("CATCH_SAMPLE_ID", S), ("SAMPLE_VALUE_WEIGHT", D),
                     ("SAMPLE_VALUE_WEIGHT_UNITS", S), ("SAMPLE_VALUE_COUNT", I), ("KEEP_FLAG", S),
                     ("RECORDING_DEVICE", S), ("RECORDER", S))

RAW_SPECIMEN = _s(("HAUL_ID", S), ("SPECIMEN_ID", S), ("CATCH_SAMPLE_ID", S), ("SPECIES_CODE", I),
                  ("RECORDING_DEVICE", S))

RAW_SPECIMEN_BIO = _s(("HAUL_ID", S), ("SPECIMEN_ID", S), ("BIOMETRIC_NAME", S), ("VALUE", D),
                      ("RECORDING_DEVICE", S))

RAW_HAUL = _s(("HAUL_ID", S), ("CRUISE_ID", S), ("HAUL", L), ("STATION", S), ("RECORDING_DEVICE", S),
              ("WEIGHT", D), ("WEIGHT_UNITS", S))

POTLIFTS = _s(("VESSEL", I), ("SPN", L), ("POT_ID", S), ("BUOY", S), ("DATE_SET", S), ("TIME_SET", S),
              ("DATE_HAUL", S), ("TIME_HAUL", S), ("LAT_DEG", D), ("LAT_MIN", D), ("LON_DEG", D), ("LON_MIN", D),
              ("DEPTH_F", D), ("GEAR_CODE", S), ("TEMP_LOGGER", S), ("NOTES", S))

HAULS = _s(("SAMPLED", I), ("STATION", S), ("LAT_DD", D), ("LON_DD", D))

POT_BYCATCH = _s(("VESSEL", I), ("SPN", S), ("POT_ID", S), ("DATE_HAUL", S),
                 *[(c, I) for c in ("MaleTanner", "FemaleTanner", "MaleSnow", "FemaleSnow", "MaleHybrid",
                                    "FemaleHybrid", "HairCrab", "PacificCod", "Halibut", "GreatSculpin",
                                    "YellowfinSole", "Pollock", "StarryFlounder", "Other")])

TEMPERATURE = _s(("latitude", D), ("longitude", D), ("temperature_C", D))

POLYGON_VERTICES = _s(("poly_id", S), ("ring", I), ("seq", I), ("x", D), ("y", D))

PLACENAMES = _s(("type", S), ("region", S), ("lab", S), ("x", D), ("y", D))
