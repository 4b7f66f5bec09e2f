"""Fixed schemas of elements and of the configuration records."""

from weftwork.functions.properties import BODY_TYPE

# one schema carries every element type; its shape differs only inside the body
ELEMENT_FIELDS = [
    ("model", "string"),
    ("kind", "string"),
    ("type_id", "string"),
    ("row_key", "string"),
    ("row_hash", "string"),
    ("element_id", "string"),
    ("direction_type", "string"),
    ("from_entity_type", "string"),
    ("from_entity_id", "string"),
    ("to_entity_type", "string"),
    ("to_entity_id", "string"),
    ("res_id", "string"),
    ("owner", "string"),
    ("body", BODY_TYPE),
]
ELEMENT_COLUMNS = [name for name, _ in ELEMENT_FIELDS]

PROPERTY = (
    "struct<uuid:string,name:string,semanticType:string,identifier:boolean,type:string,"
    "index:boolean,multivalue:boolean,stored:boolean,analyse:boolean>"
)
MODEL_RECORD = (
    "modelId string, uuid string, "
    f"entities array<struct<uuid:string,name:string,semanticType:string,rootSemanticType:string,"
    f"idProperty:{PROPERTY},properties:array<{PROPERTY}>>>, "
    f"links array<struct<uuid:string,name:string,directed:boolean,sourceEntity:string,targetEntity:string,"
    f"sourceRootSemanticType:string,targetRootSemanticType:string,labelTemplate:string,"
    f"properties:array<{PROPERTY}>>>"
)
MAPPING_RECORD = (
    "dataSchemaId string, elp string, elpType string, elpTypeDesc string, "
    "dbmap array<struct<propertyUuid:string,columnName:string>>, "
    "idToColumns array<string>, sourceColumns array<string>, targetColumns array<string>, "
    "directivity string, directionColumn string, directionValues map<string,string>"
)
CHANGE_ENTRY = "struct<elpTypeId:string,updateId:string,dataSchemaId:string>"
CHANGE_RECORD = f"elp string, seqId bigint, entities array<{CHANGE_ENTRY}>, links array<{CHANGE_ENTRY}>"
TOPIC_RECORD = "topic string, elp string, elpType string, elpTypeDesc string"
ORIGIN_SCHEMA_RECORD = "typeId string, name string, fields array<string>"
DATE_PATTERN_RECORD = "code string, name string, value struct<date:string,datetime:string,time:string>"

# element definitions, one row per entity or link type of a model
DEFINITION_PROPERTIES = "array<struct<uuid:string,name:string,type:string,analyse:boolean>>"

# change cursor, one row per element type
CHANGE_COLUMNS = ["model", "kind", "type_id", "update_id", "data_schema_id", "seq_id"]
