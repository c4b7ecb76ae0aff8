"""Fixed values that must equal the survey's own codes and labels.

FIXED VALUES — taken as-is from the survey's processing rules; listed plainly,
in their natural order.  Change only when the survey's coding changes.
"""

# Vessel codes -> names
VESSEL_NAMES = {162: "Marahute", 134: "Provider", 176: "Vesteraalen"}
POT_VESSELS = ["Marahute", "Provider"]
TRAWL_VESSELS = ["Vesteraalen"]

# Species codes
RED_KING_CRAB = 69322
TANNER_CRAB = 68560
HAIR_CRAB = 69400
SNOW_CRAB = 68580
CRAB_CODES = [68560, 69322, 69400]          # removed from the fish samples
PACIFIC_COD_VARIANT = (21722, 21720)        # variant code -> parent code
PACIFIC_COD_NAME_VARIANT = ("Pacific cod (adult)", "Pacific cod")

# Sex codes
MALE = 1
FEMALE = 2

# Size thresholds (carapace length, mm)
MATURE_MALE_MM = 120
LEGAL_MALE_MM = 135

# Zero-fill category lists
MAT_SEX_CATEGORIES = ["Mature male", "Immature male", "Mature female", "Immature female",
                      "Legal male", "Sublegal male"]
MATURITY_TOTAL_CATEGORIES = ["Mature male", "Immature male", "Mature female", "Immature female"]
SPP_SEX_CATEGORIES = ["MaleTanner", "FemaleTanner", "MaleSnow", "FemaleSnow", "MaleHybrid",
                      "FemaleHybrid", "HairCrab"]
SHELL_CATEGORIES = ["Mature male SC1", "Mature male SC2", "Mature male SC3",
                    "Mature female SC1", "Mature female SC2", "Mature female SC3"]

# Display labels for maturity categories
MAT_LABELS = {"Mature female": "Mature female", "Immature female": "Immature female",
              "Mature male": "Mature male (>= 120mm)", "Immature male": "Immature male (< 120mm)",
              "Legal male": "Legal male (>= 135mm)", "Sublegal male": "Sublegal male"}

# Bycatch species columns and display labels
BYCATCH_LABELS = {"MaleTanner": "Male Tanner crab", "FemaleTanner": "Female Tanner crab",
                  "Tanner": "Tanner crab", "MaleSnow": "Male snow crab",
                  "FemaleSnow": "Female snow crab", "Snow": "Snow crab",
                  "MaleHybrid": "Male hybrid crab", "FemaleHybrid": "Female hybrid crab",
                  "Hybrid": "Hybrid crab", "HairCrab": "Hair crab", "PacificCod": "Pacific cod",
                  "Halibut": "Pacific halibut", "GreatSculpin": "Great sculpin",
                  "YellowfinSole": "Yellowfin sole", "Pollock": "Pollock",
                  "StarryFlounder": "Starry flounder", "RockSole": "Rock sole"}
CRAB_LAYERS = ["MaleTanner", "FemaleTanner", "Tanner", "MaleSnow", "FemaleSnow", "Snow",
               "MaleHybrid", "FemaleHybrid", "Hybrid", "HairCrab"]
POT_BYCATCH_COLUMNS = ["MaleTanner", "FemaleTanner", "MaleSnow", "FemaleSnow", "MaleHybrid",
                       "FemaleHybrid", "HairCrab", "PacificCod", "Halibut", "GreatSculpin",
                       "YellowfinSole", "Pollock", "StarryFlounder", "Other"]
SEX_SUMS = {"Tanner": ("MaleTanner", "FemaleTanner"), "Snow": ("MaleSnow", "FemaleSnow"),
            "Hybrid": ("MaleHybrid", "FemaleHybrid")}
FISH_BYCATCH_COLUMNS = ["PacificCod", "Halibut", "GreatSculpin", "YellowfinSole", "Pollock",
                        "StarryFlounder", "RockSole", "Other"]

# Groundfish
FLATFISH_CODES = [10210, 10220, 10261, 10285, 10110, 10130, 10211, 10112, 10270, 10200]
UNID_FLATFISH_NAME = "flatfish unid."
UNID_FLATFISH_CODE = 10001
NON_FISH_NAMES = ["Octopus sp.", "octopus unid.", "Hanasaki king crab, Male, All Sizes"]
FISH_LABELS = {"Pacific cod": "PacificCod", "Pacific halibut": "Halibut",
               "great sculpin": "GreatSculpin", "yellowfin sole": "YellowfinSole",
               "walleye pollock": "Pollock", "starry flounder": "StarryFlounder",
               "northern rock sole": "RockSole"}
OTHER_LABEL = "Other"

# Station codes longer than this are camera, bait or coffin pots
MAX_STATION_CODE_LEN = 3

# Data-quality code sets
EGG_COLOR_CODES = [0, 2, 3, 4, 5, 6]
EGG_CONDITION_CODES = [0, 1, 2, 3, 4, 5]
CLUTCH_CODES = [0, 1, 2, 3, 4, 5, 6, 999]
SMALL_FEMALE_MM = 65
SMALL_CRAB_MM = 60
BLACK_MAT = 1
BITTER_CRAB = 2
MAX_DISEASE_CODE = 9

# Map window (degrees) and projection (Alaska Albers on GRS80)
PLOT_LAT = (54.5, 58.5)
PLOT_LON = (-164.8, -159.0)
ALBERS = {"lon0": -154.0, "lat1": 55.0, "lat2": 65.0, "lat0": 50.0,
          "a": 6378137.0, "inv_f": 298.257222101, "x0": 0.0, "y0": 0.0}
GRID_RES_M = 1000.0

# Temperature bands (edges; outer bands are open)
TEMP_BREAKS = [float("-inf"), -1.0, 0.0, 1.0, 2.0, 3.0, 4.0, float("inf")]

# Legend rounding
SCALE_ROUND_TO = 5
SCALE_N_BREAKS = 5


# FIXED: names in the drops and columns of the products, in the products' order.
BIOMETRICS = ["SEX", "WEIGHT", "CRAB_SHELL_CONDITION", "CRAB_EGG_COLOR", "CRAB_EGG_CONDITION",
              "CRAB_EGG_CLUTCH_SIZE", "CARAPACE_LENGTH", "CARAPACE_WIDTH"]
BIOMETRIC_RENAMES = {"CRAB_SHELL_CONDITION": "SHELL_CONDITION", "CRAB_EGG_COLOR": "EGG_COLOR",
                     "CRAB_EGG_CONDITION": "EGG_CONDITION", "CRAB_EGG_CLUTCH_SIZE": "CLUTCH_SIZE",
                     "CARAPACE_LENGTH": "LENGTH", "CARAPACE_WIDTH": "WIDTH"}
INT_BIOMETRICS = ["SEX", "SHELL_CONDITION", "EGG_COLOR", "EGG_CONDITION", "CLUTCH_SIZE"]

POT_SPECIMEN_COLUMNS = ["CRUISE", "VESSEL", "SPN", "POT_ID", "BUOY", "LAT_DD", "LON_DD", "DATE_HAUL", "TIME_HAUL",
                        "SOAK_TIME", "DEPTH_F", "SPECIES_CODE", "SEX", "LENGTH", "WIDTH", "SAMPLING_FACTOR",
                        "SHELL_CONDITION", "EGG_COLOR", "EGG_CONDITION", "CLUTCH_SIZE", "WEIGHT", "DISEASE_CODE",
                        "DISEASE_DORSAL", "DISEASE_VENTRAL", "DISEASE_LEGS", "CHELA_HEIGHT", "MERUS_LENGTH",
                        "COMMENTS", "NOTES"]
POTLIFT_COLUMNS = ["VESSEL", "SPN", "POT_ID", "BUOY", "DATE_SET", "TIME_SET", "LAT_DD", "LON_DD", "DEPTH_F",
                   "DATE_HAUL", "TIME_HAUL", "SOAK_TIME", "GEAR_CODE", "TEMP_LOGGER", "NOTES"]
POT_CPUE_COLUMNS = ["VESSEL", "SPN", "POT_ID", "BUOY", "LAT_DD", "LON_DD", "DATE_SET", "TIME_SET", "DATE_HAUL",
                    "TIME_HAUL", "SOAK_TIME", "MAT_SEX", "COUNT", "CATCH_PER_HOUR"]
TRAWL_SPECIMEN_COLUMNS = ["CRUISE", "VESSEL", "HAUL", "STATION", "LAT_DD", "LON_DD", "SPECIES_CODE", "SPECIES_NAME",
                          "SEX", "LENGTH", "WIDTH", "SAMPLING_FACTOR", "SHELL_CONDITION", "EGG_COLOR",
                          "EGG_CONDITION", "CLUTCH_SIZE", "WEIGHT", "DISEASE_CODE", "DISEASE_DORSAL",
                          "DISEASE_VENTRAL", "DISEASE_LEGS", "CHELA_HEIGHT", "MERUS_LENGTH", "COMMENTS", "NOTES"]
