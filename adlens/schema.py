"""Ad-log data model: the 85-column log schema, id priorities and code dictionaries.

Everything in the FIXED VALUES blocks must equal the source platform's data model
(column names and order, field types, tag codes, labels); they are data, not logic.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: the 85 log columns in file order, with their type
# (S = string, I = int, D = double).
# ---------------------------------------------------------------------------
LOG_COLUMNS: list[tuple[str, str]] = [
    ("sessionid", "S"), ("advertisersid", "I"), ("adorderid", "I"), ("adcreativeid", "I"),
    ("adplatformproviderid", "I"), ("sdkversion", "S"), ("adplatformkey", "S"),
    ("putinmodeltype", "I"), ("requestmode", "I"), ("adprice", "D"), ("adppprice", "D"),
    ("requestdate", "S"), ("ip", "S"), ("appid", "S"), ("appname", "S"), ("uuid", "S"),
    ("device", "S"), ("client", "I"), ("osversion", "S"), ("density", "S"), ("pw", "I"),
    ("ph", "I"), ("long", "S"), ("lat", "S"), ("provincename", "S"), ("cityname", "S"),
    ("ispid", "I"), ("ispname", "S"), ("networkmannerid", "I"), ("networkmannername", "S"),
    ("iseffective", "I"), ("isbilling", "I"), ("adspacetype", "I"), ("adspacetypename", "S"),
    ("devicetype", "I"), ("processnode", "I"), ("apptype", "I"), ("district", "S"),
    ("paymode", "I"), ("isbid", "I"), ("bidprice", "D"), ("winprice", "D"), ("iswin", "I"),
    ("cur", "S"), ("rate", "D"), ("cnywinprice", "D"), ("imei", "S"), ("mac", "S"),
    ("idfa", "S"), ("openudid", "S"), ("androidid", "S"), ("rtbprovince", "S"),
    ("rtbcity", "S"), ("rtbdistrict", "S"), ("rtbstreet", "S"), ("storeurl", "S"),
    ("realip", "S"), ("isqualityapp", "I"), ("bidfloor", "D"), ("aw", "I"), ("ah", "I"),
    ("imeimd5", "S"), ("macmd5", "S"), ("idfamd5", "S"), ("openudidmd5", "S"),
    ("androididmd5", "S"), ("imeisha1", "S"), ("macsha1", "S"), ("idfasha1", "S"),
    ("openudidsha1", "S"), ("androididsha1", "S"), ("uuidunknow", "S"), ("userid", "S"),
    ("iptype", "I"), ("initbidprice", "D"), ("adpayment", "D"), ("agentrate", "D"),
    ("lomarkrate", "D"), ("adxrate", "D"), ("title", "S"), ("keywords", "S"), ("tagid", "S"),
    ("callbackdate", "S"), ("channelid", "S"), ("mediatype", "I"),
]

# FIXED VALUES: user-id columns in priority order with the prefix of their kind.
ID_COLUMNS: list[tuple[str, str]] = [
    ("imei", "IM"), ("mac", "MC"), ("idfa", "ID"), ("openudid", "OD"), ("androidid", "AD"),
    ("imeimd5", "IM"), ("macmd5", "MC"), ("idfamd5", "ID"), ("openudidmd5", "OD"),
    ("androididmd5", "AD"),
    ("imeisha1", "IM"), ("macsha1", "MC"), ("idfasha1", "ID"), ("openudidsha1", "OD"),
    ("androididsha1", "AD"),
]

# FIXED VALUES: labels and codes used by reports and tags.
OTHER = "其他"            # "other": default label, anonymous user key, app-tag default
UNKNOWN = "未知"          # "unknown": renamed to OTHER by the network / carrier reports
APP_REPORT_DEFAULT = "unknow"  # app-report default for an id missing from the dictionary

OS_LABELS = {1: "android", 2: "ios"}            # anything else -> OTHER
DEVICE_LABELS = {1: "手机", 2: "平板"}           # phone, tablet; anything else -> OTHER

OS_TAGS = {1: "D00010001", 2: "D00010002", 3: "D00010003"}
OS_TAG_DEFAULT = "D00010004"
NETWORK_TAGS = {"Wifi": "D00020001", "4G": "D00020002", "3G": "D00020003", "2G": "D00020004"}
NETWORK_TAG_DEFAULT = "D00020005"
CARRIER_TAGS = {"移动": "D00030001", "联通": "D00030002", "电信": "D00030003"}
CARRIER_TAG_DEFAULT = "D00030004"

# FIXED VALUES: tag prefixes.
TAG_PREFIX_AD_SPACE = "LC"
TAG_PREFIX_AD_NAME = "LN"
TAG_PREFIX_CHANNEL = "CN"
TAG_PREFIX_APP = "APP"
TAG_PREFIX_PROVINCE = "ZP"
TAG_PREFIX_CITY = "ZC"
TAG_PREFIX_KEYWORD = "K"

# FIXED VALUES: geo box of the business-area lookup (inclusive) and geohash precision.
GEO_BOX = {"long_min": 73.0, "long_max": 136.0, "lat_min": 3.0, "lat_max": 53.0}
GEOHASH_CHARS = 6

# FIXED VALUES: keyword length bounds (inclusive, UTF-16 units) and the shipped stop words.
KEYWORD_MIN_LEN = 3
KEYWORD_MAX_LEN = 8
DEFAULT_STOP_WORDS = ["电视剧", "最新更新", "TV版", "配音语种"]

_SPARK_TYPES = {"S": T.StringType(), "I": T.IntegerType(), "D": T.DoubleType()}

LOG_SCHEMA = T.StructType(
    [T.StructField(name, _SPARK_TYPES[kind], True) for name, kind in LOG_COLUMNS]
)
LOG_COLUMN_NAMES = [name for name, _ in LOG_COLUMNS]
N_LOG_FIELDS = len(LOG_COLUMNS)
assert N_LOG_FIELDS == 85

# Columns every KPI report needs besides its dimension.
KPI_INPUT_COLUMNS = [
    "requestmode", "processnode", "iseffective", "isbilling", "isbid", "iswin",
    "adorderid", "winprice", "adpayment",
]
KPI_NAMES = [
    "raw_req", "valid_req", "ad_req", "shows", "clicks", "bids", "wins",
    "win_price_k", "ad_payment_k",
]
