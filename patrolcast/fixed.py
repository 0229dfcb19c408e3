"""Fixed values that must equal the studied scripts for the results to agree.

Everything here is a constant of the problem (map coordinates, station
positions, district names, column names, seed); no logic lives in this module.
"""

# --- fixed values: in-bounds box of the city (lon X, lat Y), inclusive ---
MIN_X, MAX_X, MIN_Y, MAX_Y = -122.515465, -122.356443, 37.707462, 37.834977

# --- fixed values: police stations (name, lon, lat); the order is the tie-break index ---
STATIONS = [
    ("Central", -122.409960, 37.798736),
    ("Ingleside", -122.446261, 37.724694),
    ("Northern", -122.432516, 37.780226),
    ("Southern", -122.389411, 37.772382),
    ("Tenderloin", -122.412924, 37.783783),
    ("Bayview", -122.397771, 37.729825),
    ("Mission", -122.421951, 37.763013),
    ("Park", -122.455391, 37.767835),
    ("Richmond", -122.464462, 37.780016),
    ("Taraval", -122.481516, 37.743755),
]

# --- fixed values: earth radius used by the haversine distance, km ---
EARTH_RADIUS_KM = 6378.137

# --- fixed values: district -> patrol division (0 = Metro, 1 = Golden Gate) ---
PATROL_DIVISION = {
    "BAYVIEW": 0, "MISSION": 0, "PARK": 0, "RICHMOND": 0, "TARAVAL": 0,
    "CENTRAL": 1, "INGLESIDE": 1, "NORTHERN": 1, "SOUTHERN": 1, "TENDERLOIN": 1,
}

# --- fixed values: the ten districts, sorted ---
DISTRICTS = ["BAYVIEW", "CENTRAL", "INGLESIDE", "MISSION", "NORTHERN",
             "PARK", "RICHMOND", "SOUTHERN", "TARAVAL", "TENDERLOIN"]

# --- fixed values: rotation angles, passed to cos/sin as radians (as the scripts do) ---
ROTATION_ANGLES = (30, 60)

# --- fixed values: period and year-group column names (model-script spelling) ---
PERIOD_COLUMNS = ["0000-0559", "0600-1759", "1800-2359"]
PERIOD_ALIASES = {"00:00-05:59": "0000-0559", "06:00-17:59": "0600-1759", "18:00-23:59": "1800-2359"}
YEAR_GROUP_COLUMNS = ["2003-2005", "2006-2009", "2010-2012", "2013-2016"]

# --- fixed values: feature sets (columns dropped per model family) ---
LINEAR_DROP = ["2010-2012", "0600-1759", "PdDistrict_TARAVAL", "Patrol_Division",
               "Polar_Rho", "Polar_Phi", "X_R30", "Y_R30", "X_R60", "Y_R60", "XY_PCA1", "XY_PCA2"]
QUADRATIC_DROP = ["2003-2005", "2013-2016", "0000-0559", "1800-2359", "0600-1759",
                  "Polar_Rho", "Polar_Phi", "XY_PCA1", "XY_PCA2", "Patrol_Division",
                  "PdDistrict_BAYVIEW", "PdDistrict_CENTRAL", "PdDistrict_INGLESIDE", "PdDistrict_MISSION",
                  "PdDistrict_NORTHERN", "PdDistrict_PARK", "PdDistrict_RICHMOND", "PdDistrict_SOUTHERN",
                  "PdDistrict_TARAVAL", "PdDistrict_TENDERLOIN"]

# --- fixed values: seed used throughout the scripts ---
SEED = 2019
