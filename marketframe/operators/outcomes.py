"""Request outcome: error enrichment, contract resolution and request fan-out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.normalize import note_json
from ..functions.timefmt import micros
from .ordered import with_row_ids
from .relational import Names, as_list, natural_join, select_distinct, small_side, top_by, without_keys


def known_codes(errors: DataFrame, codes: DataFrame) -> DataFrame:
    """Errors with ``__known``, ``__Message`` and ``Note`` of their code, NULL where ``codes`` lacks it."""
    known = codes.select("ErrorCode", F.col("Message").alias("__Message"), F.nullif(F.col("Note"), F.lit("")).alias("Note"))
    # The code table is small, so that Spark broadcasts it: the log, in which few codes stand for most
    # rows, is not shuffled by code.
    return errors.join(known.withColumn("__known", F.lit(True)), "ErrorCode", "left").select(*errors.columns, "__known", "__Message", "Note")


def first_texts(errors: DataFrame, order: Names) -> DataFrame:
    """The first error text of each code, as ErrorDescription.

    The first place is found as numbers, which keeps the aggregate hashed and combined before the shuffle;
    texts are read of rows at that place only.
    """
    at = arrival(errors, as_list(order))
    firsts = errors.groupBy("ErrorCode").agg(F.min(at).alias("__first"))
    firsts = small_side(firsts.withColumnRenamed("ErrorCode", "__code"))
    here = errors.join(firsts, F.col("ErrorCode").eqNullSafe(F.col("__code")) & at.eqNullSafe(F.col("__first")))
    return here.groupBy("ErrorCode").agg(F.min("Error").alias("ErrorDescription"))


def arrival(df: DataFrame, order: list[str]) -> Column:
    """The order columns as one value: a number for a time, a whole number or a time followed by one."""
    kinds = [df.schema[c].dataType for c in order]
    timed = isinstance(kinds[0], (T.TimestampType, T.TimestampNTZType))
    if len(order) == 1:
        return micros(F.col(order[0])) if timed else F.col(order[0])
    if len(order) == 2 and timed and isinstance(kinds[1], T.IntegralType):
        low = F.coalesce(F.col(order[1]), F.lit(0)).cast("decimal(20,0)")
        return (micros(F.col(order[0])).cast("decimal(38,0)") * F.lit("10000000000000000000").cast("decimal(20,0)") + low).cast("decimal(38,0)")
    return F.struct(*order)


def enrich_errors(errors: DataFrame, codes: DataFrame, order: Names, texts: DataFrame | None = None) -> DataFrame:
    """Add ErrorDescription and Note by code. A code absent from ``codes`` is described by the first
    error text seen with it, and has no note. ``texts`` are first texts that are known already
    (ErrorCode, ErrorDescription): without it they are learned from ``errors``."""
    rows = known_codes(errors, codes)
    found = rows.filter(F.col("__known")).select(*errors.columns, F.col("__Message").alias("ErrorDescription"), "Note")
    rest = rows.filter(F.col("__known").isNull()).drop("__known", "__Message")
    learned = first_texts(rest, order) if texts is None else texts
    return found.unionByName(natural_join(rest, small_side(learned), "ErrorCode", validate=False))


def contract_entries(
    requests: DataFrame, details: DataFrame, errors: DataFrame, key: Names, detail_key: Names
) -> DataFrame:
    """What came back for each contract asked for, one row per detail or error text.

    Details count for the contract asked for and for the contract they describe (``detail_key``
    names that contract's columns in ``details``). Error texts read ``req_id=N text``.
    """
    key, detail_key = as_list(key), as_list(detail_key)
    asked = requests.select("RequestId", *key)
    rest = [c for c in details.columns if c != "RequestId"]
    row = F.struct(*rest).alias("Detail")
    answered = details.join(asked.withColumnsRenamed({k: f"__{k}" for k in key}), "RequestId")
    # One pass over the details: each gives its request's key and, if that differs, its own.
    own = F.struct(*[F.col(d).alias(k) for d, k in zip(detail_key, key)])
    of_request = F.struct(*[F.col(f"__{k}").alias(k) for k in key])
    found = answered.select(
        F.explode(F.array_distinct(F.array(of_request, own))).alias("__key"), "RequestId", row
    ).select("__key.*", "RequestId", F.lit("detail").alias("Kind"), "Detail")
    text = F.concat(F.lit("req_id="), F.col("RequestId").cast("string"), F.lit(" "), F.col("Error"))
    failed = errors.join(asked, "RequestId").select(
        *key, "RequestId", F.lit("error").alias("Kind"), text.alias("ErrorText")
    )
    return found.unionByName(failed, allowMissingColumns=True)


def resolve_contracts(requests: DataFrame, entries: DataFrame, key: Names) -> DataFrame:
    """One row per contract: how many details and errors it has, and the status that follows.

    ``resolved`` one detail, ``multi`` several, ``error`` only errors, ``conflict`` both,
    ``missing`` neither. Counts are combined before the shuffle, so a contract with very many
    answers is no heavier than another.
    """
    key = as_list(key)
    asked = requests.select(*key, F.lit(0).alias("__d"), F.lit(0).alias("__e"))
    is_detail = (F.col("Kind") == "detail").cast("int")
    seen = entries.select(*key, is_detail.alias("__d"), (1 - is_detail).alias("__e"))
    counts = asked.unionByName(seen).groupBy(*key)
    n, e = F.col("DetailCount"), F.col("ErrorCount")
    status = (
        F.when((n > 0) & (e > 0), "conflict")
        .when(n > 1, "multi")
        .when(n == 1, "resolved")
        .when(e > 0, "error")
        .otherwise("missing")
    )
    counted = counts.agg(F.sum("__d").alias("DetailCount"), F.sum("__e").alias("ErrorCount"))
    return counted.withColumn("Status", status)


def joined_errors(entries: DataFrame, key: Names, most: int = 10) -> DataFrame:
    """One row per contract with errors: the first ``most`` error texts, by request and text, joined by ``|``, and the count of all.

    Texts are limited before the shuffle, so a contract with very many errors is no heavier than another;
    equal texts of one request count once among the first.
    """
    keys = as_list(key)
    errors = entries.filter(F.col("Kind") == "error")
    counts = errors.groupBy(*keys).agg(F.count(F.lit(1)).alias("ErrorCount"))
    texts = errors.select(*keys, "RequestId", "ErrorText").distinct()
    firsts = top_by(texts, keys, [F.col("RequestId"), F.col("ErrorText")], most)
    in_order = F.sort_array(F.collect_list(F.struct("RequestId", "ErrorText")))
    joined = firsts.groupBy(*keys).agg(F.array_join(F.transform(in_order, lambda e: e["ErrorText"]), "|").alias("ErrorText"))
    return natural_join(counts, joined, keys, validate=False)


def keys_to_request(contracts: DataFrame, known: DataFrame, key: Names, contract_id: str = "ContractId"):
    """Contracts to look up: each once, none already known, none with a negative id."""
    wanted = contracts.filter(F.col(contract_id).isNull() | (F.col(contract_id) >= 0))
    keys = as_list(key)
    return without_keys(select_distinct(wanted, keys), known, keys)


def fan_out_requests(
    calls: DataFrame,
    details: str,
    request_type: str,
    notes: Mapping[str, Column],
    order: Names,
    bucket: Column,
    spread: str,
    first_id: int = 1,
) -> DataFrame:
    """One request per contract detail of each call, numbered in call order, with its JSON note.
    ``bucket`` and ``spread`` say how the calls are split for numbering: see :func:`with_row_ids`."""
    rows = calls.select("*", F.posexplode(details).alias("DetailIndex", "Detail"))
    numbered = with_row_ids(rows, [*as_list(order), "DetailIndex"], bucket, spread, first_id)
    return numbered.withColumn("RequestType", F.lit(request_type)).withColumn("Note", note_json(notes))


def active_only(rows: DataFrame, cancels: DataFrame, at: str = "ReceiveTime") -> DataFrame:
    """Rows received before their request was cancelled (at the first cancel; never, without one)."""
    first = cancels.groupBy("RequestId").agg(F.min("CancelTime").alias("__CancelTime"))
    open_ = F.col("__CancelTime").isNull() | (F.col(at) <= F.col("__CancelTime"))
    return natural_join(rows, first, "RequestId", validate=False).filter(open_).drop("__CancelTime")
