"""Request-event logs: fixed fields as text, request headers, parameters and rest attributes."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.requests import read_request
from millrace.functions.strings import is_blank

# --- Fixed values
COPIED_FIELDS = ["@timestamp", "pid", "source", "offset", "category", "name", "ip", "id", "trackId", "username", "uuid",
                 "uid", "hostname", "use", "tags", "atTime", "date"]
RESPONSE_FIELDS = ["respType", "respLength", "respStatus"]
PROFILE = "PROFILE"
UNSUPPORTED, BAD_VARIABLES = "unsupported request", "bad variables"
# --- end of fixed values


REQUEST = T.StructType([T.StructField(n, T.StringType()) for n in ("type", "name", "params", "errorMessage")])


@F.pandas_udf(REQUEST)
def _requests(payload: pd.Series, variables: pd.Series) -> pd.DataFrame:
    """Header and parameters per request; null payloads are profile events. A request that
    comes several times in a batch is read once."""
    def one(text: str | None, given: str | None) -> tuple:
        if text is None:
            return PROFILE, None, None, None
        try:
            known = json.loads(given) if given else {}
            kind, name, params = read_request(text, known)
        except (ValueError, IndexError, KeyError):
            return None, None, None, UNSUPPORTED
        if params is known and given:  # a named operation answers with its variables as they came
            return kind, name, given.strip(), None
        return kind, name, None if params is None else json.dumps(params, ensure_ascii=False, separators=(",", ":")), None

    memo: dict[tuple, tuple] = {}
    rows = []
    for key in zip(payload, variables):
        if key not in memo:
            memo[key] = one(*key)
        rows.append(memo[key])
    return pd.DataFrame(rows, columns=REQUEST.names, dtype=object)


def read_variables(text: Column) -> Column:
    """Variables as JSON text with their own types and nesting: as they came where that is
    strict JSON, else rewritten from unquoted names and single quotes. Null if unreadable."""
    strict = F.try_parse_json(text).isNotNull()
    lenient = F.from_json(text, T.MapType(T.StringType(), T.VariantType()), {"allowUnquotedFieldNames": "true"})
    return F.when(strict, text).otherwise(F.to_json(lenient))


def with_request(df: DataFrame, payload: Column, variables: Column, prefix: str = "") -> DataFrame:
    """Add ``type``, ``name``, ``params`` (JSON text) and ``errorMessage``.

    A blank payload is a PROFILE event. Otherwise the first definition counts: its
    operation, its name (or the only field of an unnamed one) and its parameters,
    the variables of a named operation or the field's arguments of an unnamed one.
    """
    cut = df.withColumns({"__payload": F.when(~is_blank(payload), payload), "__text": F.when(~is_blank(variables), variables)})
    cut = cut.withColumn("__vars", read_variables(F.col("__text")))
    cut = cut.withColumn("__request", _requests("__payload", "__vars"))
    bad = F.col("__payload").isNotNull() & F.col("__text").isNotNull() \
        & (F.col("__vars").isNull() | ~F.col("__text").rlike(r"^\s*\{(?s:.*)\}\s*$"))
    request = F.col("__request")
    error = F.coalesce(request["errorMessage"], F.when(bad, BAD_VARIABLES))
    parts = {n: F.when(error.isNull(), request[n]) for n in ("type", "name", "params")} | {"errorMessage": error}
    # one-element inline: a filter on the result stays above it and does not repeat the parse
    answer = F.inline(F.array(F.struct(*[value.alias(f"{prefix}{part}") for part, value in parts.items()])))
    return cut.select(*[F.col(f"`{c}`") for c in df.columns], answer)


def attributes_of(df: DataFrame, column: str = "attrs") -> Column:
    """The event's attributes as a text map, whatever struct or map they come as."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.MapType):
        return F.transform_values(column, lambda _, v: v.cast("string"))
    as_json = F.col(column) if isinstance(kind, T.StringType) else F.to_json(column)
    return F.from_json(as_json, T.MapType(T.StringType(), T.StringType()))


def normalise_events(df: DataFrame, payload: str = "requestPayload", variables: str = "requestVariables",
                     attrs: str = "attrs") -> DataFrame:
    """Fixed fields as text (missing ones empty), request header and parameters,
    response facts, and the attributes that are left; a row without attributes has no
    type and no response facts. ``route`` is ``success`` or,
    for a request that cannot be read, ``failure`` with the reason."""
    fixed = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in df.columns else F.lit("") for c in COPIED_FIELDS}
    base = df.select(attributes_of(df, attrs).alias("__attrs"), *[v.alias(k) for k, v in fixed.items()])

    def attribute(name: str) -> Column:
        return F.coalesce(F.try_element_at("__attrs", F.lit(name)), F.lit(""))

    given = F.col("__attrs").isNotNull()
    lifted = [payload, variables, *RESPONSE_FIELDS]
    requested = with_request(base, attribute(payload), attribute(variables), prefix="request_")
    return requested.select(
        *[F.col(f"`{c}`") for c in COPIED_FIELDS if c != "name"],
        F.coalesce("request_name", "name").alias("name"), F.when(given, F.col("request_type")).alias("type"),
        F.col("request_params").alias("params"), *[F.when(given, attribute(c)).alias(c) for c in RESPONSE_FIELDS],
        F.map_filter("__attrs", lambda k, _: ~k.isin(lifted)).alias("attrs"),
        F.when(F.col("request_errorMessage").isNull(), "success").otherwise("failure").alias("route"),
        F.col("request_errorMessage").alias("errorMessage"))
