"""Silver layer: standardise raw rows, then keep-first dedup by id."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwatch import schemas as S
from txwatch.functions import columns as C


# Columns that follow from the other silver columns.
DERIVED = ("amount_log", "tx_hour", "tx_day_of_week", "is_weekend", "is_cross_currency")
# Columns that order rows for dedup; carried through standardisation.
BOOKKEEPING = ("chunk_id", "copy_no", "row_in_chunk")
# What is made of each bronze row once and written with it: its time, whether it is
# bad, and the hash of its id.
TIME, BAD, HASH = "_ts", "_bad", "_h"
# Values of HASH: few enough to take five bytes, and so many that ids hardly share one.
HASHES = 1 << 40


def bronze_id(bronze: DataFrame, with_format_in_id: bool = True) -> Column:
    """The transaction id of raw columns."""
    src = F.col("source") if "source" in bronze.columns else F.lit(S.SOURCE_IBM)
    return C.transaction_id(src, "Timestamp", "Account_sender", "Account_receiver", "Amount Paid",
                            "Payment Format" if with_format_in_id else None)


def to_stored(bronze: DataFrame, bad: Column, same: Mapping[str, str] | None = None) -> DataFrame:
    """Bronze rows as they are written once for all later layers: with ``TIME``,
    ``BAD`` (``bad``, or a time that cannot be read) and ``HASH`` (null for bad
    rows); the time's text only where ``TIME`` does not give it, and without the
    columns that are the ``same`` as another."""
    df = bronze.withColumn(TIME, C.parse_timestamp("Timestamp"))
    df = df.withColumn(BAD, bad | F.col(TIME).isNull())
    df = df.withColumn(HASH, F.when(~F.col(BAD), F.pmod(F.xxhash64(bronze_id(bronze)), F.lit(HASHES))))
    text = F.col("Timestamp")
    df = df.withColumn("Timestamp", F.when(~text.eqNullSafe(F.col(TIME).cast("string")), text))
    return df.drop(*(same or {}))


def from_stored(stored: DataFrame, columns: Sequence[str], same: Mapping[str, str] | None = None) -> DataFrame:
    """The ``columns`` of bronze again, and ``TIME``, ``BAD`` and ``HASH``."""
    given = {"Timestamp": F.coalesce(F.col("Timestamp"), F.col(TIME).cast("string")).alias("Timestamp"),
             **{c: F.col(of).alias(c) for c, of in (same or {}).items()}}
    return stored.select(*[given.get(c, F.col(c)) for c in columns], TIME, BAD, HASH)


def standardize(bronze: DataFrame, with_format_in_id: bool = True,
                with_sender_key: bool = False) -> DataFrame:
    """Raw columns -> the 19 silver columns (plus any bookkeeping columns
    such as ``chunk_id`` and ordinals, which are carried through).

    ``with_sender_key`` adds ``sender_key``, a SHA-256 of the raw sender
    account: windows keyed on it keep apart accounts whose masked forms
    collide (same last four characters), without storing the account."""
    keep = [c for c in bronze.columns if c.startswith("src_") or c in BOOKKEEPING]
    ts = F.col(TIME) if TIME in bronze.columns else C.parse_timestamp("Timestamp")
    src = F.col("source") if "source" in bronze.columns else F.lit(S.SOURCE_IBM)
    tx_id = bronze_id(bronze, with_format_in_id)
    df = bronze.select(
        tx_id.alias("transaction_id"),
        ts.alias("timestamp"),
        C.mask_account("Account_sender").alias("sender_account_masked"),
        C.mask_account("Account_receiver").alias("receiver_account_masked"),
        F.col("From Bank").cast("string").alias("sender_bank"),
        F.col("To Bank").cast("string").alias("receiver_bank"),
        F.col("Amount Paid").cast("double").alias("amount"),
        C.currency_code("Payment Currency").alias("payment_currency"),
        C.currency_code("Receiving Currency").alias("receiving_currency"),
        F.col("Payment Format").alias("payment_type"),
        F.col("Is Laundering").cast("bigint").alias("is_laundering"),
        (F.col("typology") if "typology" in bronze.columns
         else F.lit(None).cast("string")).alias("typology"),
        src.alias("source"),
        F.col("ingested_at").cast("string").alias("ingested_at"),
        F.col("Account_sender").cast("string").alias("_raw_sender"),
        *keep,
    )
    df = with_derived(df)
    if with_sender_key:
        keep = ["sender_key", *keep]
        df = df.withColumn("sender_key", F.sha2(F.col("_raw_sender"), 256))
    return df.select(*S.SILVER_COLUMNS, *keep)


def with_derived(df: DataFrame) -> DataFrame:
    """The ``DERIVED`` columns from time, amount and currencies."""
    df = df.withColumns({
        "amount_log": C.amount_log("amount"),
        "tx_hour": C.tx_hour("timestamp"),
        "tx_day_of_week": C.tx_day_of_week("timestamp"),
    })
    return df.withColumns({
        "is_weekend": C.is_weekend("tx_day_of_week"),
        "is_cross_currency": C.is_cross_currency("payment_currency", "receiving_currency"),
    })


def packed_ordinal(parts: Sequence[tuple[str, int]]) -> Column:
    """Lexicographic order of non-negative integral columns as ONE
    ``decimal(38,0)``: every column after the first takes a fixed number of
    digits (its values must stay below 10**digits). A single comparable key
    lets the first-copy aggregate run as a hash aggregate (a struct key would
    force a sort-based one)."""
    width = sum(d for _, d in parts[1:])
    if width >= 38:
        raise ValueError("ordinal does not fit in 38 digits")
    key = F.col(parts[0][0]).cast("decimal(38,0)")
    for c, d in parts[1:]:
        key = key * F.lit(10 ** d).cast("decimal(38,0)") + F.col(c).cast("decimal(38,0)")
    return key.cast("decimal(38,0)")


def mark_duplicates(df: DataFrame, id_col: str = "transaction_id", chunk_col: str = "chunk_id",
                    order_cols: Sequence[str] = (), order_key: Column | None = None) -> DataFrame:
    """Add ``dead_reason``: null for the first copy of an id, else
    ``intra_chunk_duplicate`` (not first inside its chunk) or
    ``inter_chunk_duplicate`` (first in its chunk, id seen in an earlier chunk).

    "First" means the smallest ``(chunk, order_cols)`` (or ``order_key``,
    one comparable column, e.g. ``packed_ordinal``). Built from partial
    aggregates (min per (id, chunk), then min chunk per id) and one join back,
    so an id with very many copies is combined map-side and the join's hot
    key is split by AQE, never gathered into one window task. Every row comes
    back: a null id has no duplicates and stays (the silver gate reports it), a
    null chunk is dead as ``unknown_chunk``.
    """
    if order_key is not None:
        pos = order_key
    elif len(order_cols) == 1:
        pos = F.col(order_cols[0])
    else:
        pos = F.struct(*[F.col(c) for c in order_cols])
    # The aggregate branch reads only id, chunk and ordinal columns (pruned
    # scan) and combines map-side before its small shuffle; the rows move
    # once, in the join.
    firsts = df.groupBy(id_col, chunk_col).agg(F.min(pos).alias("_first_pos"))
    # first chunk per id over the small (id, chunk) table (a hot id has one
    # row per chunk here), without deriving the table a second time
    marks = firsts.withColumn("_first_chunk", F.min(chunk_col).over(Window.partitionBy(id_col)))
    marks = marks.withColumnsRenamed({id_col: "_id", chunk_col: "_chunk"})
    j = df.join(marks, (F.col(id_col) == F.col("_id")) & (F.col(chunk_col) == F.col("_chunk")), "left")
    reason = (F.when(F.col(id_col).isNull(), F.lit(None).cast("string"))
              .when(F.col(chunk_col).isNull(), F.lit("unknown_chunk"))
              .when(pos != F.col("_first_pos"), F.lit("intra_chunk_duplicate"))
              .when(F.col(chunk_col) != F.col("_first_chunk"), F.lit("inter_chunk_duplicate")))
    return j.withColumn("dead_reason", reason).drop("_id", "_chunk", "_first_pos", "_first_chunk")


# Places of the marks of ids that come twice, and how many of them one row holds (4 KB).
PLACES, PLACES_A_ROW = 1 << 28, 1 << 15
AGAIN = "_again"


def place_bits(hashes: DataFrame, places: int = PLACES) -> DataFrame:
    """A map of ``places`` bits (at most 32 MB) in which each hash (column ``_h``) sets one."""
    return (hashes.select(F.pmod(F.col(HASH), F.lit(places)).alias("_at"))
            .groupBy(F.expr(f"_at div {PLACES_A_ROW}").alias("_row"))
            .agg(F.bitmap_construct_agg(F.expr(f"_at % {PLACES_A_ROW}")).alias("_bits")))


def at_place(df: DataFrame, bits: DataFrame, name: str, key: Column, places: int = PLACES) -> DataFrame:
    """Add ``name``: whether the bit of the hash ``key`` is set in the (broadcast) map of bits."""
    own = df.withColumn("_at", F.pmod(key, F.lit(places)))
    own = own.withColumn("_row", F.expr(f"_at div {PLACES_A_ROW}"))
    j = own.join(F.broadcast(bits), "_row", "left")
    byte = f"cast(conv(hex(substring(_bits, cast(_at % {PLACES_A_ROW} div 8 as int) + 1, 1)), 16, 10) as bigint)"
    is_set = F.expr(f"getbit({byte}, cast(_at % 8 as int)) = 1")
    return j.withColumn(name, F.when(F.col("_bits").isNull(), F.lit(False)).otherwise(is_set)).select(*df.columns, name)


def with_place(df: DataFrame, hashes: DataFrame, name: str, id_col: str = "transaction_id", places: int = PLACES) -> DataFrame:
    """Add ``name``: false only where the hash of the row's id is none of ``hashes``
    (another id whose place in the map of bits is taken counts as one of them)."""
    return at_place(df, place_bits(hashes, places), name, F.xxhash64(id_col), places)


def twice(hashes: DataFrame) -> DataFrame:
    """The hashes (column ``_h``) that come more than once; nulls are none. Only they move."""
    known = hashes.where(F.col(HASH).isNotNull()).groupBy(HASH).agg(F.count(F.lit(1)).alias("_n"))
    return known.where(F.col("_n") > 1).select(HASH)


def id_hash(id_col: str = "transaction_id") -> Column:
    """The hash of an id (null without one)."""
    return F.when(F.col(id_col).isNotNull(), F.pmod(F.xxhash64(id_col), F.lit(HASHES)))


def with_again(df: DataFrame, id_col: str = "transaction_id", places: int = PLACES) -> DataFrame:
    """Add ``_again``: false only where no other row has the row's id. Only the ids' hashes move."""
    return with_place(df, twice(df.select(id_hash(id_col).alias(HASH))), AGAIN, id_col, places)


def only_ids_of(df: DataFrame, ids: DataFrame, id_col: str = "transaction_id", places: int = PLACES) -> DataFrame:
    """The rows of ``df`` that a join with ``ids`` on the id may meet, and a few more: nothing moves but the map of bits."""
    hashes = ids.where(F.col(id_col).isNotNull()).select(F.xxhash64(id_col).alias(HASH))
    return with_place(df.where(F.col(id_col).isNotNull()), hashes, "_met", id_col, places).where("_met").drop("_met")


def mark_stored_duplicates(rows: DataFrame, make: Callable[[DataFrame], DataFrame], keep: Callable[[DataFrame], DataFrame],
                           id_col: str = "transaction_id", chunk_col: str = "chunk_id", order_cols: Sequence[str] = (),
                           order_key: Column | None = None, places: int = PLACES) -> DataFrame:
    """``mark_duplicates`` of what ``make`` makes of written ``rows`` with their ids'
    ``HASH``. The map of bits and the rows whose id may come again, compared with
    each other, are written by ``keep``; the others stay where they are."""
    bits = keep(place_bits(twice(rows.select(HASH)), places))
    rows = at_place(rows, bits, AGAIN, F.col(HASH), places)
    alone = make(rows.where(~F.col(AGAIN)).drop(AGAIN))
    no_chunk = F.col(id_col).isNotNull() & F.col(chunk_col).isNull()
    alone = alone.withColumn("dead_reason", F.when(no_chunk, F.lit("unknown_chunk")))
    again = make(rows.where(F.col(AGAIN)).drop(AGAIN))
    return alone.unionByName(keep(mark_duplicates(again, id_col, chunk_col, order_cols, order_key)))


def mark_duplicates_kept(df: DataFrame, keep: Callable[[DataFrame], DataFrame], id_col: str = "transaction_id",
                         chunk_col: str = "chunk_id", order_cols: Sequence[str] = (), order_key: Column | None = None,
                         places: int = PLACES) -> DataFrame:
    """``mark_duplicates`` of rows that are written once (by ``keep``): only those
    whose id may come again are compared, the others stay where they are."""
    rows = keep(df.withColumn(HASH, id_hash(id_col)))
    return mark_stored_duplicates(rows, lambda part: part.drop(HASH), keep, id_col, chunk_col, order_cols, order_key, places)


def dedup(df: DataFrame, order_cols: Sequence[str], id_col: str = "transaction_id",
          chunk_col: str = "chunk_id") -> tuple[DataFrame, DataFrame]:
    """(kept, dead) where dead carries ``dead_reason``."""
    marked = mark_duplicates(df, id_col, chunk_col, order_cols)
    kept = marked.where(F.col("dead_reason").isNull()).drop("dead_reason")
    dead = marked.where(F.col("dead_reason").isNotNull())
    return kept, dead


def incremental_split(new: DataFrame, published: DataFrame,
                      id_col: str = "transaction_id") -> tuple[DataFrame, DataFrame]:
    """(unseen, seen) rows of ``new`` against an already published silver."""
    ids = published.select(id_col)
    return new.join(ids, id_col, "left_anti"), new.join(ids, id_col, "left_semi")


def to_unified(df: DataFrame, source: str) -> DataFrame:
    """Map a source in its own layout to the 13 unified columns."""
    if source == S.SOURCE_IBM:
        mapped = df.select(
            C.transaction_id(F.lit(source), "Timestamp", "Account_sender", "Account_receiver",
                             "Amount Paid", "Payment Format").alias("transaction_id"),
            C.parse_timestamp("Timestamp").alias("timestamp"),
            F.col("Account_sender").alias("sender_account"),
            F.col("Account_receiver").alias("receiver_account"),
            F.col("From Bank").alias("sender_bank"),
            F.col("To Bank").alias("receiver_bank"),
            F.col("Amount Paid").alias("amount"),
            C.currency_code("Payment Currency").alias("payment_currency"),
            C.currency_code("Receiving Currency").alias("receiving_currency"),
            F.col("Payment Format").alias("payment_type"),
            F.col("Is Laundering").cast("bigint").alias("is_laundering"),
        )
    elif source == S.SOURCE_SAML:
        mapped = df.select(
            C.transaction_id(F.lit(source), "timestamp", "from_account", "to_account",
                             "amount", "payment_type").alias("transaction_id"),
            C.parse_timestamp("timestamp").alias("timestamp"),
            F.col("from_account").alias("sender_account"),
            F.col("to_account").alias("receiver_account"),
            F.col("from_bank").alias("sender_bank"),
            F.col("to_bank").alias("receiver_bank"),
            F.col("amount"),
            C.currency_code("currency").alias("payment_currency"),
            C.currency_code("currency").alias("receiving_currency"),
            F.col("payment_type"),
            F.col("is_laundering").cast("bigint").alias("is_laundering"),
            F.col("typology"),
        )
    else:
        raise ValueError(f"unknown source {source!r}")
    return mapped.withColumn("source", F.lit(source))


def union_sources(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*S.UNIFIED_COLUMNS)
