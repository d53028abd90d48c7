"""Column expressions for cleaning application fields, and the table jobs made of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Telephone patterns, whole text must match.
PHONE_STRICT = [
    r"((17[0-9])(14[0-9])|(13[0-9])|(15[^4,\D])|(18[0,5-9]))\d{8}",
    r"(\(\+?86\))(0[0-9]{2,3}\-?)?([2-9][0-9]{6,7})+(\-[0-9]{1,4})?",
    r"(86-?)?(0[0-9]{2,3}\-?)?([2-9][0-9]{6,7})+(\-[0-9]{1,4})?",
    r"[1-9]{1}[0-9]{5,8}",
]
# The first pattern with its missing bar and its missing 181-184 put right.
PHONE_FIXED = [r"(17[0-9]|14[0-9]|13[0-9]|15[0-35-9]|18[0-9])\d{8}", *PHONE_STRICT[1:]]
ZERO_DEVICE = "00000000-0000-0000-0000-000000000000"  # fixed value


def clean_text(c: Column) -> Column:
    """Blank text and the word null become the empty string."""
    return F.when(c.isNull() | (F.trim(c) == "") | (F.lower(c) == "null"), F.lit("")).otherwise(c)


def clean_token(c: Column, comma: str = "", only_comma: bool = False) -> Column:
    """``clean_text`` with the separators ``,`` ``&`` ``#`` taken out."""
    out = F.replace(clean_text(c), F.lit(","), F.lit(comma))
    return out if only_comma else F.translate(out, "&#", "@")


def is_phone(c: Column, mode: str = "fixed") -> Column:
    patterns = PHONE_STRICT if mode == "strict" else PHONE_FIXED
    joined = "|".join(f"(?:{p})" for p in patterns)
    return F.coalesce(c.rlike(f"^(?:{joined})$"), F.lit(False))


def clean_entity(c: Column, kind: str, recommend_lengths: Sequence[int] = range(5, 12)) -> Column:
    """Rules by kind of entity: zero device, lower-case e-mail, recommender length."""
    text = clean_text(c)
    if kind == "device":
        return F.when(text == ZERO_DEVICE, F.lit("")).otherwise(text)
    if kind == "email":
        return F.lower(text)
    if kind == "recommend":
        return F.when(F.length(text).isin(*recommend_lengths), text).otherwise(F.lit(""))
    return text


def strip_hyphen(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(""))


def stable_id(value: Column, kind: Column | None = None) -> Column:
    """Signed 64-bit id: the first 8 bytes of the MD5 of ``value`` or ``value&kind``."""
    text = value if kind is None else F.concat_ws("&", value, kind)
    return F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("long")


def to_second(c: Column) -> Column:
    """Time text without its fraction."""
    return F.substring_index(c, ".", 1)


def day_of(c: Column) -> Column:
    return F.substring(c, 1, 10)


def clean_applications(df: DataFrame, phones: Sequence[str], tokens: Mapping[str, str]) -> DataFrame:
    """Clean every named column of an application table in one projection.

    ``tokens`` maps a column to the text its commas become; an entry of
    ``None`` takes out commas only. Phone columns that are no telephone
    number become empty.
    """
    cols = []
    for name in df.columns:
        c = F.col(name)
        if name in phones:
            c = F.when(is_phone(c), clean_token(c)).otherwise(F.lit(""))
        elif name in tokens:
            comma = tokens[name]
            c = clean_token(c, comma or "", only_comma=comma is None)
        cols.append(c.alias(name))
    return df.select(*cols)


def in_window(ts: Column, start: str, end: str, lag_days: int = 0) -> Column:
    """Inclusive window test on time text; false where it cannot be parsed."""
    t = F.try_to_timestamp(ts).cast("timestamp_ntz")
    lag = F.expr(f"INTERVAL {int(lag_days)} DAYS")
    lo = F.lit(start).cast("timestamp_ntz") - lag
    hi = F.lit(end).cast("timestamp_ntz") - lag
    return F.coalesce(t.between(lo, hi), F.lit(False))


def until(df: DataFrame, ts: str, end: str) -> DataFrame:
    """Rows at or before ``end``; rows without a readable time are dropped."""
    return df.where(F.try_to_timestamp(F.col(ts)).cast("timestamp_ntz") <= F.lit(end).cast("timestamp_ntz"))


def calendar_columns(df: DataFrame, ts: str, zone: str = "Asia/Shanghai") -> DataFrame:
    """Day, hour and second text, month ends, and the UTC instant as ISO text."""
    c = F.col(ts)
    utc = F.to_utc_timestamp(c.cast("timestamp"), zone)
    return df.select(
        "*",
        F.date_format(c, "yyyy-MM-dd").alias("day"),
        F.date_format(c, "yyyy-MM-dd HH").alias("hour"),
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias("second"),
        F.trunc(c, "month").alias("month_first"),
        F.last_day(c).alias("month_last"),
        F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso_utc"),
    )


def recode(c: Column, mapping: Mapping, default=None) -> Column:
    """Value replacement with a default bucket (``None`` keeps the value)."""
    out = None
    for old, new in mapping.items():
        out = F.when(c == old, F.lit(new)) if out is None else out.when(c == old, F.lit(new))
    return out.otherwise(c if default is None else F.lit(default))


def as_category(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def split_between(c: Column, left: str, right: str) -> Column:
    """Text after the first ``left`` up to the next ``right``."""
    after = F.element_at(F.split(c, _quoted(left), 2), 2) if left else c
    return F.substring_index(after, right, 1)


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Named derived columns; later ones may use earlier ones."""
    for name, expr in columns.items():
        df = df.withColumn(name, expr)
    return df


def hour_of_day(seconds: Column) -> Column:
    return F.pmod(F.ceil(seconds / 3600), F.lit(24))


def geo_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the law of cosines, radius 6371 km."""
    a, b = F.radians(lat1), F.radians(lat2)
    cos = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(F.radians(lon2 - lon1))
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cos))) * 6371.0


# Message field -> application column.
APPLY_FIELDS = {"orderId": "orderno", "insertTime": "insert_time", "termId": "termid", "loanPan": "loan_pan"}
USER_FIELDS = {
    "userId": "userid",
    "mobile": "mobile",
    "certNo": "certno",
    "contactMobile": "contactmobile",
    "emergencyContactMobile": "emergencymobile",
    "compAddr": "companyaddress",
    "company": "companyname",
    "email": "email",
}


def parse_application(df: DataFrame, body: str, now: Column | None = None) -> DataFrame:
    """Unpack a message whose object holds two JSON strings.

    Messages that are not an object of that form give NULL in every field;
    a missing insert time becomes ``now`` (default: the current time).
    """
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if now is None else now
    outer = F.from_json(F.col(body), "cLoanApply string, cApplyUser string")
    loan = F.from_json(F.col("_o.cLoanApply"), "map<string,string>")
    user = F.from_json(F.col("_o.cApplyUser"), "map<string,string>")
    fields = [F.col("_l")[k].alias(v) for k, v in APPLY_FIELDS.items()]
    fields += [F.col("_u")[k].alias(v) for k, v in USER_FIELDS.items()]
    out = df.withColumn("_o", outer).withColumn("_l", loan).withColumn("_u", user).select(*df.columns, *fields)
    return out.withColumn(
        "insert_time", F.when(F.col("orderno").isNotNull(), F.coalesce("insert_time", now))
    )
