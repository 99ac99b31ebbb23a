"""Fixed values that results depend on: names, codes, patterns, message texts."""

# Row divisions of a work row.
UPSERT = "U"
DELETE = "D"
REPLACE = "L"
DIVISIONS = (UPSERT, DELETE, REPLACE)

# Author id written to system columns and log rows.
ETL_ID = "ETL"

# System columns of work and target tables.
CREATE_COLUMNS = ("create_id", "create_dtt")
UPDATE_COLUMNS = ("last_upd_id", "last_upd_dtt")
STAMP_COLUMNS = CREATE_COLUMNS + UPDATE_COLUMNS
SYSTEM_COLUMNS = ("process_div",) + STAMP_COLUMNS + ("error_flg",)

# Column that dates a source row for the incremental extract.
UPDATE_TIME = "update_date_time"

# Texts that stand for "no value" in a source row.
NULL_TEXTS = ("", "nan", "NaT")

# Rule names allowed in the control table's validation list.
REQUIRED = "Required"
MAX_LENGTH = "MaxLength"
MIN_LENGTH = "MinLength"
MAX_VALUE = "MaxValue"
MIN_VALUE = "MinValue"
VALUE_RULES = (REQUIRED, MAX_LENGTH, MIN_LENGTH, MAX_VALUE, MIN_VALUE)

# Target type families, by the names a database catalogue gives.
SMALLINT_TYPES = ("smallint", "int2")
INTEGER_TYPES = ("integer", "int4")
BIGINT_TYPES = ("bigint", "int8")
FLOAT_TYPES = ("real", "double", "double precision", "float4", "float8", "float")
DECIMAL_TYPES = ("decimal", "numeric")
DATE_TYPES = ("date",)
TIMESTAMP_TYPES = ("timestamp without time zone", "timestamp with time zone")
TIME_TYPES = ("time", "timetz", "time without time zone", "time with time zone")
SINGLE_BYTE_TYPES = ("char", "character")
STRING_TYPES = SINGLE_BYTE_TYPES + ("nchar", "bpchar", "character varying", "nvarchar", "text")
BOOLEAN_TYPES = ("boolean", "bool")

# Text patterns. \z rather than $: a trailing newline is not part of a number.
INT_PATTERN = r"^-?[0-9]+\z"
DECIMAL_PATTERN = r"^-?[0-9]+(\.[0-9]+)?\z"
PRINTABLE_PATTERN = r"^[ -~]*\z"
TRUE_TEXTS = ("TRUE", "True", "true")
FALSE_TEXTS = ("FALSE", "False", "false")

# Text length from which a number counts as overflow, and the float limit.
LONG_NUMBER = 20
FLOAT_LIMIT = float("9" * 30)

# Rows per block of a bulk insert.
BLOCK_ROWS = 5000

# Longest message kept in the log table.
MESSAGE_LENGTH = 4999

# Log levels, in the order in which a code is tested for them.
LEVELS = ("Info", "Warn", "Error", "Fatal")

# Message texts by code, with a suffix where one code has two texts. Words in braces are filled in.
MESSAGES = {
    "Info001": "バッチ処理を開始します。",
    "Info002": "バッチ処理を終了します。",
    "Info003": "対象テーブルの取り込みを開始します。",
    "Info004": "{table}で{count}件のデータを{action}しました。",
    "Info005": "処理合計件数:{total}件、正常終了:{normal}件、エラー:{error}件。",
    "Info006": "データの取り込みを完了します。",
    "Info006stopped": "対象テーブルの取り込みを完了します。",
    "Info007": "処理対象テーブルが存在しないためバッチ処理を終了します。",
    "Info010": "処理対象データが存在しないため処理をスキップします。",
    "Error001": "更新対象が存在しません。",
    "Error003": "{item}は必須項目です。",
    "Error004": "{item}が重複しています。",
    "Error006": "{item}は{actual}桁ですが{limit}桁以下の必要があります。",
    "Error007": "{item}は{actual}桁ですが{limit}桁以上の必要があります。",
    "Error008": "{item}は{actual}ですが{limit}以下の必要があります。",
    "Error009": "{item}は{actual}ですが{limit}以上の必要があります。",
    "Error010": "{item}は{type}型の必要があります。",
    "Error015": "ファイル内の処理区分に「U」「D」以外が設定されています。",
    "Error016": "ファイル内の処理区分に「L」以外が設定されています。",
    "Fatal003": "顧客IDが不正です。",
    "Fatal007": " 対象テーブルの取り込みに失敗しました。【{reason}】",
    "Fatal008": " DBでの処理時にエラーが発生しました。【{reason}】",
    "Fatal010": "制御マスタに更新時キーが定義されていません。",
    "Fatal011": "制御マスタの妥当性検査項目に未定義のパラメータが設定されています。",
    "Fatal012": "制御マスタに最大桁が未定義のデータがあります。",
    "Fatal013": "制御マスタに最小桁が未定義のデータがあります。",
    "Fatal016max": "制御マスタに最大値が未定義のデータがあります。",
    "Fatal016min": "制御マスタに最小値が未定義のデータがあります。",
    "Fatal018": "ファイル内に処理区分が設定されていません。",
    "Fatal019": "ファイル内の処理区分に「L」と「U」「D」が設定されています。",
}

# Joins the key names in the duplicate-key message.
KEY_JOINER = "と"

# Words of the action text.
ACTION_INSERT = "登録"
ACTION_UPSERT = "登録/更新"
ACTION_DELETE = "削除"
ACTION_DEFAULT = "処理"

# Schema owners left out of an inventory.
SYSTEM_OWNERS = (
    "SYS", "SYSTEM", "XDB", "CTXSYS", "MDSYS",
    "ORDSYS", "OUTLN", "DBSNMP", "APPQOSSYS", "AUDSYS",
)
OBJECT_KINDS = ("TABLE", "VIEW")

# Warehouse layers and the privileges each role has on them.
LAYERS = ("stg", "core", "dm", "ext")
LAYER_GRANTS = (
    ("role_admin", "stg", "write"), ("role_admin", "stg", "read"),
    ("role_admin", "core", "write"), ("role_admin", "core", "read"),
    ("role_admin", "dm", "write"), ("role_admin", "dm", "read"),
    ("role_admin", "ext", "write"), ("role_admin", "ext", "read"),
    ("role_etl_writer", "stg", "write"), ("role_etl_writer", "stg", "read"),
    ("role_etl_writer", "core", "write"), ("role_etl_writer", "core", "read"),
    ("role_bi_reader", "dm", "read"),
)

# The largest hour, minute and second of a time of day, and the largest offset east and west in hours.
CLOCK_LIMITS = (23, 59, 59)
OFFSET_HOURS = {"+": 14, "-": 12}
OFFSET_MINUTES = 59
