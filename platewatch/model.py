"""Relations the engine works on.

A *sighting* says that a plate passed a site at a moment.  Inside the engine it has the
columns id, plate, brand, colour, pass_time, site_id, lon and lat; the field names used
on the wire (CSV headers, message keys) are kept in the maps below.
"""

# The field names of the exchanged files, messages and tables.
CSV_FIELDS = {
    "id": "ID",
    "plate": "HPHM",
    "brand": "CLPP",
    "colour": "CLYS",
    "pass_time": "TGSJ",
    "site_id": "KKBH",
    "position": "KK_LON_LAT",
}
MESSAGE_FIELDS = {
    "plate": "HPHM",
    "brand": "CLPP",
    "colour": "CLYS",
    "pass_time": "TGSJ",
    "site_id": "KKBH",
}
# Columns of a sighting in the store.
SIGHTING = {
    "id": "string",
    "plate": "string",
    "brand": "string",
    "colour": "string",
    "pass_time": "timestamp_ntz",
    "site_id": "string",
    "lon": "double",
    "lat": "double",
}
CLONE_TABLE = "t_tpc_result"
ALERT_TABLE = "t_bk_tpc"
TOPIC = "traffic_topic"

# One message is a JSON array of flat string maps.
MESSAGE_TYPE = "array<map<string,string>>"

# Defaults of the analyses.
MAX_KMH = 180
TOLERANCE_S = 180
SEQUENCE_LENGTH = 3
TRIGGER = "6 seconds"
