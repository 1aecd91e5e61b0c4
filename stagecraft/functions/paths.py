"""Path and listing-text functions as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The stage-path key rules, tested in this order, each
# case-insensitive and on the first occurrence. A rule that matches drops
# everything up to and including the first "/" after the matched marker
# (for the bare "stages/" marker: after the segment that follows it).
# If no "/" follows, the path is kept whole. A path with no "/" at all has
# no key (null).
S3_MARKER = r"(?i)s3://"
S3_PREFIX = r"(?is)^.*?s3://[^/]*/"
AZURE_MARKER = r"(?i)azure://"
AZURE_PREFIX = r"(?is)^.*?azure://[^/]*/"
STAGES_MARKER = r"(?i)stages/"
STAGES_PREFIX = r"(?is)^.*?stages/[^/]*/"
STAGE_ID_MARKER = r"(?i)stages[a-zA-Z0-9]{4,10}-[a-zA-Z0-9]{4}-[a-zA-Z0-9]{4}-[a-zA-Z0-9]{4}-[a-zA-Z0-9]{12}/"
STAGE_ID_PREFIX = (r"(?is)^.*?stages[a-zA-Z0-9]{4,10}-[a-zA-Z0-9]{4}-[a-zA-Z0-9]{4}"
                   r"-[a-zA-Z0-9]{4}-[a-zA-Z0-9]{12}/")
FIRST_SEGMENT = r"^[^/]*/"

# Listing text looks like "Wed, 8 Sep 2021 15:22:01 GMT";
# the last four characters are the zone, always GMT.
LISTING_TIME_FORMAT = "d MMM yyyy HH:mm:ss"

RULES = [
    (S3_MARKER, S3_PREFIX),
    (AZURE_MARKER, AZURE_PREFIX),
    (STAGES_MARKER, STAGES_PREFIX),
    (STAGE_ID_MARKER, STAGE_ID_PREFIX),
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stage_path_shorten(path: Column | str) -> Column:
    """Location-independent key of a staged file path (cloud/stage prefix removed).

    Null for null input and for a path without any "/".
    """
    c = _col(path)
    expr = None
    for marker, prefix in RULES:
        cond, value = c.rlike(marker), F.regexp_replace(c, prefix, "")
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.when(F.instr(c, "/") > 0, F.regexp_replace(c, FIRST_SEGMENT, ""))


def stage_path_shorten_sql(col_sql: str, dialect: str = "duckdb") -> str:
    """The same rule as SQL text, for DuckDB (oracle) or Spark SQL."""
    match = "regexp_matches" if dialect == "duckdb" else "regexp_like"
    parts = ["case"]
    for marker, prefix in RULES:
        parts.append(f"when {match}({col_sql}, '{marker}') "
                     f"then regexp_replace({col_sql}, '{prefix}', '')")
    parts.append(f"when instr({col_sql}, '/') > 0 then regexp_replace({col_sql}, '{FIRST_SEGMENT}', '')")
    parts.append("end")
    return " ".join(parts)


def last_modified_to_timestamp(text: Column | str) -> Column:
    """Listing time text ("Wed, 8 Sep 2021 15:22:01 GMT") -> UTC timestamp.

    The weekday is removed before parsing because Spark does not parse day
    names; the zone (last four characters) is dropped and the time read as UTC.
    """
    c = _col(text)
    body = c.substr(F.lit(1), F.length(c) - F.lit(4))
    body = F.regexp_replace(body, r"^[A-Za-z]{3}, ", "")
    return F.to_timestamp_ntz(body, F.lit(LISTING_TIME_FORMAT))


def timestamp_to_listing_text(ts: Column | str) -> Column:
    """The inverse, used to build a listing from tables: timestamp -> listing text."""
    return F.concat(F.date_format(_col(ts), "EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT"))


def parent_dir(path: Column | str) -> Column:
    """Path without its last segment."""
    return F.regexp_replace(_col(path), r"/[^/]*$", "")


def path_key(path: Column | str, default_fs: str) -> Column:
    """One spelling of a file path: with its file system and a single "/" behind the scheme.

    ``/a/x``, ``file:/a/x`` and ``file:///a/x`` name one file; paths without a
    file system belong to ``default_fs``.
    """
    c = _col(path)
    full = F.when(c.startswith("/"), F.concat(F.lit(default_fs), c)).otherwise(c)
    # The commonest spelling by plain tests: the pattern costs more than the rest of reading a row.
    local = full.startswith("file:///") & ~full.startswith("file:////")
    return F.when(local, F.concat(F.lit("file:"), F.substring(full, 8, 1 << 30))) \
        .otherwise(F.regexp_replace(full, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/"))


def hidden_name(path: Column | str) -> Column:
    """Whether Spark's file readers pass a file over for its name (fixed rule of Spark's file index)."""
    name = F.regexp_extract(F.col(path) if isinstance(path, str) else path, "[^/]*$", 0)
    return (name.startswith("_") & ~name.contains("=")) | name.startswith(".") | name.endswith("._COPYING_")


def is_hidden(path: str) -> bool:
    """``hidden_name`` of one path."""
    name = path.rsplit("/", 1)[-1]
    return name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")
