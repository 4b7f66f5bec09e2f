"""Fixed values of the wire format.

They must equal what existing stores and consumers of the graph expect, so
they are stated here once and used everywhere else by name.
"""

# separators
KEY_SEPARATOR = "@"
ID_SEPARATOR = "~`#"
NAME_SEPARATOR = "_"
PATTERN_SEPARATOR = "@"

# element kinds, as written in mappings and as used in table names
ENTITY = "Entity"
LINK = "Link"
ENTITY_TABLE = "entity"
LINK_TABLE = "relation"

# directivity of a mapping and the code stored on a link
NOT_DIRECTED = "NotDirected"
SOURCE_TO_TARGET = "SourceToTarget"
TARGET_TO_SOURCE = "TargetToSource"
BIDIRECTIONAL = "Bidirectional"
CODE_UNDIRECTED = "0"
CODE_ONE_WAY = "1"
CODE_TWO_WAY = "2"

# property types
TEXT = "text"
STRING = "string"
DATE = "date"
DATETIME = "datetime"
TIME = "time"
NUMBER = "number"

# dynamic search-field prefix of each property type
FIELD_PREFIXES = {
    "bool": "g_bn11_",
    "date": "g_rd11_",
    "datetime": "g_rd11_",
    "time": "g_tk11_",
    "integer": "g_it11_",
    "number": "g_de11_",
    "text": "g_tt11_",
    "string": "g_tk11_",
}
INDEXED_AT_FIELD = "_indexed_at_tdt"

# wide-column families
PROPERTY_FAMILY = "property"
LINK_FAMILY = "link"
RESOURCE_QUALIFIER = "resid"

# identifier arrays
IDENTIFIER_TYPES = ("mail", "imsi", "imei", "mac", "phone")
MAC_TYPE = "mac"
MAC_SEPARATOR = ":"

# value forms
DATE_FORM = r"^[0-9]{4}(-[0-9]{1,2}){2}$"
DATETIME_FORM = r"^[0-9]{4}(-[0-9]{1,2}){2}\s[0-9]{1,2}(:[0-9]{1,2}){2}$"
TIME_FORM = r"^[0-9]{1,2}(:[0-9]{1,2}){2}$"
EPOCH_FORM = r"^[0-9]+$"
NUMBER_FORM = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"
NUMBER_SENTINEL = "-1"
PATTERN_ZONE = "+08:00"
DATE_PATTERN_CODE = "system.elpmodel.entity.property.transform.supported.datetime.format"

# dossiers
DOC_KEY_SEPARATOR = "@"
# doc type -> field -> the one value that replaces any non-empty value
CONSTANT_TAGS = {"PEOPLE": {"tab_s_showTag": "重点人员"}}

# metrics and task history
TRANSFORM_METRIC = "trans.task.resid"
LOAD_METRIC = "load.task.resid"
TASK_SUCCESSFUL = "successful"
