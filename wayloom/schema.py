"""Types of the rows that enter the engine."""

PING_PAYLOAD = (
    "vehicle string, driver string, datetime bigint, x double, y double, speed double, heading double, "
    "ignition boolean, aircon boolean, working boolean, door_up boolean, door_down boolean"
)
PING_FILE = f"msgBusWayPoint struct<{', '.join(f.strip().replace(' ', ':', 1) for f in PING_PAYLOAD.split(','))}>"
ROUTES_CSV = "vehicle string, route_id string, route_no string"
PING_FIELDS = ("vehicle", "driver", "datetime", "x", "y", "speed", "heading", "ignition", "aircon", "working", "doorUp", "doorDown")
#: Names of fields in a message, and in a row, with their types.
MESSAGE_FIELDS = {
    "vehicle": ("vehicle", "string"), "driver": ("driver", "string"), "datetime": ("datetime", "bigint"), "x": ("x", "double"), "y": ("y", "double"),
    "speed": ("speed", "double"), "heading": ("heading", "double"), "ignition": ("ignition", "boolean"), "aircon": ("aircon", "boolean"),
    "working": ("working", "boolean"), "door_up": ("doorUp", "boolean"), "door_down": ("doorDown", "boolean"),
}
ENVELOPE, MESSAGE_TYPE = "msgBusWayPoint", "MsgType_BusWayPoint"
