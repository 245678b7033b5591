"""Row-level scalars: keys, predicates, parsers.  All built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetry_engine.functions.timeutil import format_rfc3339_nano, matches_whole
from telemetry_engine.schemas import PREFETCH_MAX, PREFETCH_MIN, UUID_PATTERN

INT_REGEX = r"[+-]?[0-9]+"
# One Prometheus-style label: name="value" with backslash escapes in value.
LABEL_REGEX = r'([A-Za-z_][A-Za-z0-9_.]*)="((?:[^"\\]|\\.)*)"'


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_empty(c: Column | str) -> Column:
    """Null -> '' (the engine's canonical absent text)."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def trim_whitespace(c: Column | str) -> Column:
    """Trim leading/trailing Unicode whitespace (tabs, newlines, NBSP, ideographic space...)."""
    return F.regexp_replace(_c(c), r"^\p{IsWhite_Space}+|\p{IsWhite_Space}+$", "")


def empty_to_null(c: Column | str) -> Column:
    c = _c(c)
    return F.when(c != "", c)


def uuid_is_valid(c: Column | str) -> Column:
    return F.coalesce(matches_whole(_c(c), UUID_PATTERN), F.lit(False))


def device_key(hostname: Column | str, device_id: Column | str) -> Column:
    """Alternate device identity ``hostname:device_id``."""
    return F.concat(_c(hostname), F.lit(":"), _c(device_id))


def point_key(gpu_uuid, metric_name, batch_id, ts) -> Column:
    """Intended uniqueness of a telemetry point.

    ``uuid:metric:batch_id``, or ``uuid:metric:<RFC3339 nano ts>`` when the
    batch id is empty.
    """
    b = _c(batch_id)
    suffix = F.when(F.coalesce(b, F.lit("")) != "", b).otherwise(format_rfc3339_nano(ts))
    return F.concat_ws(":", _c(gpu_uuid), _c(metric_name), suffix)


def parse_int(c: Column | str) -> Column:
    """Strict base-10 integer text -> bigint, else null (overflow too)."""
    c = _c(c)
    return F.when(matches_whole(c, INT_REGEX), c.try_cast("bigint"))


def metadata_get(c: Column | str, key: str) -> Column:
    """Struct (found, value) of one key of a JSON object in text.

    ``found`` is true for a key that is there, also with a JSON null; ``value``
    is its text, or the JSON text of what is no string; null for null or absent.
    Text that is no object holds no key.
    """
    raw = F.from_json(_c(c), f"struct<`{key}`: variant>")[key]
    kind = F.schema_of_variant(raw)
    value = F.when(kind == "STRING", F.try_variant_get(raw, "$", "string")).when(kind != "VOID", F.to_json(raw))
    found = F.coalesce(_c(c).rlike(r"\A\s*\{"), F.lit(False)) & raw.isNotNull()
    return F.struct(found.alias("found"), value.alias("value"))


def header_get(c: Column | str, key: str) -> Column:
    """Struct (found, value) of one key of a map."""
    return F.struct(F.coalesce(F.map_contains_key(_c(c), key), F.lit(False)).alias("found"),
                    F.try_element_at(_c(c), F.lit(key)).alias("value"))


def clamp(c: Column | str, lo: int = PREFETCH_MIN, hi: int = PREFETCH_MAX) -> Column:
    return F.least(F.greatest(_c(c), F.lit(lo)), F.lit(hi))


def numeric_value(c: Column | str) -> Column:
    """Telemetry value text -> double; non-numeric text -> null."""
    return _c(c).try_cast("double")


def label_pairs(c: Column | str) -> Column:
    """``k1="v1",k2="v2"`` -> array<struct<label_key, label_value>>.

    Commas inside quoted values are kept; a repeated key keeps its last value.
    """
    c = _c(c)
    found = F.struct(F.regexp_extract_all(c, F.lit(LABEL_REGEX), 1).alias("keys"),
                     F.regexp_extract_all(c, F.lit(LABEL_REGEX), 2).alias("vals"))
    # inside a lambda an expression is computed again for every element, a lambda's variable is not
    return F.transform(F.array(found), lambda f: _pairs(f["keys"], f["vals"]))[0]


def _pairs(keys: Column, vals: Column) -> Column:
    n = F.size(keys)
    # positions whose key does not occur again later in the list
    last_of_key = F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (i <= n)
        & ~F.array_contains(
            F.slice(keys, i + 1, F.greatest(n - i, F.lit(0))), F.try_element_at(keys, i)
        ),
    )
    return F.transform(
        last_of_key,
        lambda i: F.struct(
            F.element_at(keys, i).alias("label_key"),
            F.regexp_replace(F.element_at(vals, i), r"\\(.)", "$1").alias("label_value"),
        ),
    )


def labels_map(c: Column | str) -> Column:
    return F.map_from_entries(label_pairs(c))
