"""Column types of the four input tables. Columns not listed stay text."""

# Names as they stand in the files.
INCIDENT_TYPES = {
    "DR_NO": "bigint",
    "TIME OCC": "int",
    "AREA": "int",
    "Weapon Used Cd": "int",
    "LAT": "double",
    "LON": "double",
}

# Fixed value: the column with the date, ``MM/dd/yyyy hh:mm:ss a``.
INCIDENT_DATE = "DATE OCC"

# The older extract has a blank after the name.
INCIDENT_RENAMES = {"AREA ": "AREA"}

# Names as they stand in the file.
INCOME_TYPES = {"Zip Code": "int"}

# Names as they stand in the file.
GEOCODE_TYPES = {"LAT": "double", "LON": "double"}

# Names as they stand in the file; x is the longitude, y the latitude.
STATION_TYPES = {"OBJECTID": "int", "PREC": "int", "x": "double", "y": "double"}
