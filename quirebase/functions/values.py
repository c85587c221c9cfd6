"""Small expressions on sizes, money, vectors and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Requests a day and a minute of each model family.
RATE_LIMITS = {"lite": (1000, 15), "flash": (250, 10), "pro": (25, 5), "embedding": (1000, 5)}
#: Codes of departments; any other has ENG.
DEPARTMENT_CODES = {
    "CHEMICAL ENGINEERING": "CHE", "COMPUTER ENGINEERING": "COE", "CIVIL ENGINEERING": "CVL", "ELECTRICAL ENGINEERING": "EEE", "MECHANICAL ENGINEERING": "MEE",
    "MECHATRONICS ENGINEERING": "MCT", "PETROLEUM ENGINEERING": "PTE", "BIOMEDICAL ENGINEERING": "BME", "AERONAUTICAL ENGINEERING": "AAE",
}
#: Suffixes of files that are deleted, and that are converted.
DELETED = (".m", ".matcad", ".htm", ".html", ".mp3", ".mp4", ".aac", ".ogg", ".mat", ".tmp", ".dthumb", ".eml", ".ods", ".xlsx", ".xls")
CONVERTED = (".docx", ".txt", ".ppt", ".pptx", ".odt")
#: Fixed value: a size with its unit.
SIZE = r"(?i)\b([0-9]+(?:\.[0-9]+)?)([BKMG])\b"


def json_text(text: Column) -> Column:
    """A string as JSON in ASCII: other characters as escapes of their UTF-16 units."""
    quoted = F.to_json(F.struct(text.alias("v")))
    inner = F.substring(quoted, F.lit(6), F.length(quoted) - 6)
    units = F.transform(F.split(inner, ""), lambda c: F.when(c.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")).otherwise(c))
    return F.when(inner.rlike(r"[^\x00-\x7F]"), F.array_join(units, "")).otherwise(inner)


def canonical_key(*args: Column | dict[str, Column]) -> Column:
    """Sixteen hex digits of a call's arguments as canonical JSON: keys in order, a space after each comma and colon.

    Arguments are JSON texts (see ``json_text``), or objects of them.
    """
    pieces: list[Column] = []
    for arg in args:
        whole = arg if isinstance(arg, Column) else F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{k}": '), arg[k].cast("string")) for k in sorted(arg)]), F.lit("}"))
        pieces.append(whole)
    return F.left(F.sha2(F.concat(F.lit('{"args": ['), F.concat_ws(", ", *pieces), F.lit('], "kwargs": {}}')), 256), F.lit(16))


def human_bytes(n: Column) -> Column:
    """Bytes in the largest of B to TB that keeps the number at 1 or more, with a decimal from KB on."""
    f = n.cast("double")
    shown = lambda k, unit: F.concat(F.format_string("%.1f", F.bround(f / 1024**k, 1)), F.lit(f" {unit}"))
    return F.when(f < 1024, F.concat(n.cast("bigint").cast("string"), F.lit(" B"))).when(f < 1024**2, shown(1, "KB")).when(f < 1024**3, shown(2, "MB")).when(f < 1024**4, shown(3, "GB")).otherwise(shown(4, "TB"))


def parse_size(text: Column) -> Column:
    """Bytes of the first number with a unit B, K, M or G; null without one."""
    unit = F.upper(F.regexp_extract(text, SIZE, 2))
    factor = F.when(unit == "B", 1.0).when(unit == "K", 1024.0).when(unit == "M", 1024.0**2).when(unit == "G", 1024.0**3)
    return F.nullif(F.regexp_extract(text, SIZE, 1), F.lit("")).cast("double") * factor


def reduction_percent(before: Column, after: Column) -> Column:
    return (1 - after / F.greatest(F.lit(1), before)) * 100


def cost(tokens: Column, price: str = "0.012") -> Column:
    """Price of tokens at a price for a million of them, as DECIMAL(18,9)."""
    return (tokens.cast("decimal(18,0)") * F.lit(price).cast("decimal(9,6)") / F.lit(1_000_000)).cast("decimal(18,9)")


def model_family(name: Column) -> Column:
    out = F.when(F.contains(name, F.lit("lite")), "lite")
    for family in ("flash", "pro", "embedding"):
        out = out.when(F.contains(name, F.lit(family)), family)
    return out.otherwise("flash")


def fit_vector(v: Column, size: int) -> Column:
    """Cut to ``size`` elements or padded with zeros; null gives zeros."""
    zeros = F.array_repeat(F.lit(0.0).cast("float"), size)
    return F.slice(F.concat(F.coalesce(v, F.array().cast("array<float>")), zeros), 1, size)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def suffix(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"[^/](\.[^./]+)\z", 1))


def file_action(name: Column) -> Column:
    return F.when(suffix(name).isin(*DELETED), "delete").when(suffix(name).isin(*CONVERTED), "convert").otherwise("keep")
