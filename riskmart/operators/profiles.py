"""Per-client aggregates of transactions and logins.

The count of suspicious rows compares every amount with a multiple of the
client's own mean. A client may own a large share of all rows, so no step
gathers the rows of one client in one task.

First the rows of a client are summed up per band of amounts (quarters of a
power of two), which is a plain aggregate with map-side combine; a client's
bands then become one row with a short list. Most bands lie wholly above or
below the client's threshold, by their least and largest amount, and up to
three rows of a band are known from least, largest and sum. What is left is at
most one band per flagged client, and only the rows of these bands are read
again (``method="bands"``):

* bands with a large share of all rows are few, so their thresholds are
  broadcast whatever the table size, and their rows are never shuffled;
* the others pass a Bloom filter over (client, band) of fixed greatest size and
  are shuffled once to meet their thresholds.

``method="salt"`` is the plain form: one join of all rows with the totals.
``method="local"`` is for bucketed tables without hot clients, see
:mod:`riskmart.plans.colocated`.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.risk import AMOUNT_FACTOR, exceeds_mean, mean
from riskmart.operators.settling import settled

HOT_LIMIT = 10_000
#: Thresholds of hot bands are broadcast; there are at most as many as the limit says.
MOST_HOT = 100_000
ROWS_PER_SALT = 1_000_000
SALT_ON = ("transaction_id", "amount")
CLIENT = "client_id"

#: Bands per power of two, and the band of all amounts that have no logarithm.
BANDS, LOW_BAND = 4, -1_000
#: A band of so many rows is known from its least amount, its largest and its sum.
KNOWN_ROWS = 3
#: The Bloom filter: blocks of 512 words, bits set per key, bits per key asked for, and the greatest number of blocks,
#: which makes 64 MB. Beyond that the filter lets more rows pass; results do not change.
WORDS, PROBES, BITS_PER_KEY, MOST_BLOCKS = 512, 4, 12, 16_384

MONEY, SUM = "decimal(15,2)", "decimal(25,2)"


def client_totals(tx: DataFrame) -> DataFrame:
    """Row count, amount count, sum and maximum per client."""
    return tx.groupBy(CLIENT).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count("amount").alias("amount_count"),
        F.sum("amount").alias("amount_sum"),
        F.max("amount").alias("max_transaction_amount"),
    )


def band_of() -> Column:
    """The band of `amount`. Spark's logarithm is the same on all machines; only that matters, not where a band ends."""
    return F.expr(f"CASE WHEN amount > 0 THEN int(floor(log2(double(amount)) * {BANDS})) WHEN amount IS NOT NULL THEN {LOW_BAND} END")


def client_bands(tx: DataFrame) -> DataFrame:
    """Per client the list of its bands: rows, amounts, sum, least and largest of each.

    All that later steps use comes out of the list, the client as well. So no filter or projection of theirs reaches
    the aggregate, its plan is the same in every branch, and its shuffle is made once.
    """
    sums = ("count(1) AS n", "count(amount) AS k", f"cast(sum(amount) AS {SUM}) AS s", "min(amount) AS low", "max(amount) AS high")
    per_band = tx.groupBy(CLIENT, band_of().alias("band")).agg(*map(F.expr, sums))
    entry = ", ".join(f"'{name}', {name}" for name in (CLIENT, "band", "n", "k", "s", "low", "high"))
    bands = per_band.groupBy(CLIENT).agg(F.expr(f"collect_list(named_struct({entry})) AS bands"))
    return bands.selectExpr(f"bands[0].{CLIENT} AS {CLIENT}", "bands")


def band_profile(tx: DataFrame, factor: float) -> DataFrame:
    """Per client: totals, the suspicious rows that bands tell (`sure`), and the band that has to be read again (`open`).

    `open` holds band and rows, and is NULL where nothing is left to read, which includes rows without a client.
    """

    def folded(of: str, kind: str) -> str:
        return f"aggregate(bands, cast(0 AS {kind}), (a, b) -> cast(a + coalesce(b.{of}, 0) AS {kind}))"

    def above(value: str) -> str:
        return f"{value} * amount_count > amount_sum * {Decimal(str(factor))}BD"

    totals = settled(
        client_bands(tx),
        total_transactions=folded("n", "bigint"),
        amount_count=folded("k", "bigint"),
        known_sum=folded("s", SUM),
        max_transaction_amount="array_max(transform(bands, b -> b.high))",
    )
    # A sum of no amounts is NULL, as in any aggregate.
    edges = settled(
        totals,
        amount_sum="if(amount_count > 0, known_sum, NULL)",
        edge=f"if(amount_count > 0, double(known_sum) * {float(factor)}D / amount_count, NULL)",
        margin=f"if(amount_count > 0, abs(double(known_sum) * {float(factor)}D / amount_count) * 1e-9D + 1e-9D, NULL)",
    )
    # Doubles settle all bands but the one or two near the threshold; these are compared exactly.
    near = settled(
        edges,
        near="filter(bands, b -> b.k > 0 AND double(b.high) >= edge - margin AND double(b.low) <= edge + margin)",
        clear="aggregate(bands, 0L, (a, b) -> a + if(b.k > 0 AND double(b.low) > edge + margin, b.k, 0L))",
    )
    # Least and largest lie on both sides here, so one of two or three rows is above; the third is told by the sum.
    middle = f"if(b.k = {KNOWN_ROWS} AND {above(f'cast(b.s - b.low - b.high AS {MONEY})')}, 1L, 0L)"
    known = f"CASE WHEN {above('b.low')} THEN b.k WHEN NOT {above('b.high')} THEN 0L WHEN b.k <= {KNOWN_ROWS} THEN 1L + {middle} ELSE 0L END"
    unsettled = f"filter(near, b -> b.k > {KNOWN_ROWS} AND {above('b.high')} AND NOT {above('b.low')})"
    found = settled(
        near,
        sure=f"if({CLIENT} IS NULL, 0L, coalesce(clear + aggregate(near, 0L, (a, b) -> a + {known}), 0L))",
        open=f"if({CLIENT} IS NULL, NULL, transform({unsettled}, b -> named_struct('band', b.band, 'n', b.n)))",
    )
    return found.select(CLIENT, "total_transactions", "amount_count", "amount_sum", "max_transaction_amount", "sure", "open")


def _hot_limit(hot_limit: int) -> int:
    if not 0 < hot_limit <= MOST_HOT:
        raise ValueError(f"hot_limit must lie between 1 and {MOST_HOT}")
    return hot_limit


def _is_hot(rows: Column, totals: DataFrame, hot_limit: int) -> Column:
    """Whether so many rows are 1/hot_limit of all or more. All rows are counted from the totals, without another scan."""
    return rows * F.lit(_hot_limit(hot_limit)) >= totals.agg(F.sum("total_transactions")).scalar()


def _count_suspicious(rows: DataFrame, totals: DataFrame, on: list[str], factor: float) -> DataFrame:
    return (
        rows.join(totals, on)
        .where(exceeds_mean(F.col("amount"), F.col("amount_count"), F.col("amount_sum"), factor))
        .groupBy(CLIENT)
        .agg(F.count(F.lit(1)).alias("suspicious_transaction_count"))
    )


def _probe(k: int) -> str:
    """The k-th bit of a key in its block, in [0, 64 * WORDS)."""
    return f"pmod(xxhash64({CLIENT}, band, {k}), {64 * WORDS}L)"


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64(CLIENT, "band"), blocks).alias("block")


def _bloom_blocks(keys: DataFrame) -> Column:
    """How many blocks the filter has: it follows the number of keys up to a limit, so its table has a greatest size."""
    return keys.agg(F.expr(f"bigint(least({MOST_BLOCKS}, count(1) * {BITS_PER_KEY} div {64 * WORDS} + 1))")).scalar()


def bloom_filter(keys: DataFrame, blocks: Column) -> DataFrame:
    """A Bloom filter over (client, band) as a table: a row per block, with the words of its bits."""
    bits = keys.select(_block(blocks), F.expr(f"explode(array({', '.join(map(_probe, range(PROBES)))})) AS bit"))
    words = bits.groupBy("block", F.expr("int(shiftright(bit, 6)) AS word")).agg(F.expr("bit_or(shiftleft(1L, int(bit & 63))) AS mask"))
    by_block = words.groupBy("block").agg(F.expr("map_from_entries(collect_list(struct(word, mask))) AS masks"))
    return by_block.selectExpr("block", f"transform(sequence(0, {WORDS - 1}), w -> coalesce(masks[w], 0L)) AS words")


def passing(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose (client, band) may be among the keys; none that is gets lost."""
    blocks = _bloom_blocks(keys)
    hits = (f"(shiftright(get(words, int(shiftright({_probe(k)}, 6))), int({_probe(k)} & 63)) & 1) = 1" for k in range(PROBES))
    met = rows.select("*", _block(blocks)).join(F.broadcast(bloom_filter(keys, blocks)), "block")
    return met.where(" AND ".join(hits)).select(*rows.columns)


def _suspicious_by_bands(tx: DataFrame, profile: DataFrame, hot_limit: int, factor: float) -> DataFrame:
    """Suspicious rows per client among the rows of open bands."""
    rows = tx.select(CLIENT, "amount", band_of().alias("band")).where(f"{CLIENT} IS NOT NULL AND band IS NOT NULL")
    left = profile.select(CLIENT, "amount_count", "amount_sum", F.inline("open"))
    hot = _is_hot(F.col("n"), profile, hot_limit)
    on = [CLIENT, "band"]
    from_hot = _count_suspicious(rows, F.broadcast(left.where(hot).drop("n")), on, factor)
    cold = left.where(~hot).drop("n")
    from_cold = _count_suspicious(passing(rows, cold), cold, on, factor)
    both = from_hot.unionByName(from_cold)
    return both.groupBy(CLIENT).agg(F.sum("suspicious_transaction_count").alias("reread"))


def _flagged(totals: DataFrame, factor: float) -> DataFrame:
    """Clients whose largest amount is suspicious, i.e. those with a count above zero."""
    return totals.where(
        exceeds_mean(F.col("max_transaction_amount"), F.col("amount_count"), F.col("amount_sum"), factor)
    )


def _with_amounts(totals: DataFrame) -> DataFrame:
    """Clients with any amount at all. Naming every total keeps the aggregate below whole, so
    that its shuffle is the one shared by all branches instead of a second, narrower one."""
    known = F.col("amount_sum").isNotNull() & F.col("max_transaction_amount").isNotNull()
    return totals.where((F.col("amount_count") > 0) & known)


def _suspicious_by_salt(
    tx: DataFrame, totals: DataFrame, factor: float, hot_limit: int, rows_per_salt: int
) -> DataFrame:
    """One join for all clients; rows of hot clients are spread over several salts.

    The salt comes from the row's content, so a retried task repeats it; only id and
    amount are used, to keep the scan narrow. Identical rows share a salt. The result
    is not needed in join order, so adaptive execution may still split their partition.
    """
    hot = _is_hot(F.col("total_transactions"), totals, hot_limit)
    salts = F.when(hot, F.ceil(F.col("total_transactions") / F.lit(rows_per_salt))).otherwise(F.lit(1))
    spread = _with_amounts(totals).where(hot).select(CLIENT, salts.alias("salts"))
    content = F.xxhash64(*(F.col(c) for c in tx.columns if c in SALT_ON))
    rows = tx.join(F.broadcast(spread), CLIENT, "left").select(
        CLIENT, "amount", F.pmod(content, F.coalesce(F.col("salts"), F.lit(1))).alias("salt")
    )
    salted = _flagged(totals, factor).select(
        CLIENT,
        "amount_count",
        "amount_sum",
        F.explode(F.sequence(F.lit(0).cast("bigint"), salts.cast("bigint") - 1)).alias("salt"),
    )
    return _count_suspicious(rows, salted, [CLIENT, "salt"], factor)


def _profile_by_bands(tx: DataFrame, factor: float, hot_limit: int) -> DataFrame:
    profile = band_profile(tx, factor)
    counts = _suspicious_by_bands(tx, profile, hot_limit, factor)
    total = F.col("sure") + F.coalesce("reread", F.lit(0))
    return profile.join(counts, CLIENT, "left").withColumn("suspicious_transaction_count", total)


def hot_clients(rows: DataFrame, hot_limit: int = HOT_LIMIT) -> DataFrame:
    """Clients with 1/hot_limit of all rows or more; there are at most hot_limit of them."""
    counts = rows.groupBy(CLIENT).agg(F.count(F.lit(1)).alias("total_transactions"))
    return counts.where(_is_hot(F.col("total_transactions"), counts, hot_limit) & F.col(CLIENT).isNotNull()).select(CLIENT)


def _profile_by_client(tx: DataFrame, factor: float) -> DataFrame:
    """For rows that lie together by client already: every step stays in the partition of the client."""
    totals = client_totals(tx)
    counts = _count_suspicious(tx.select(CLIENT, "amount"), totals.select(CLIENT, "amount_count", "amount_sum"), [CLIENT], factor)
    return totals.join(counts, CLIENT, "left").withColumn(
        "suspicious_transaction_count", F.coalesce("suspicious_transaction_count", F.lit(0))
    )


def _profile_by_salt(tx: DataFrame, factor: float, hot_limit: int, rows_per_salt: int) -> DataFrame:
    totals = client_totals(tx)
    known = totals.where(F.col(CLIENT).isNotNull())
    counts = _suspicious_by_salt(tx.where(F.col(CLIENT).isNotNull()), known, factor, hot_limit, rows_per_salt)
    return totals.join(counts, CLIENT, "left").withColumn(
        "suspicious_transaction_count", F.coalesce("suspicious_transaction_count", F.lit(0))
    )


def tx_profile(
    tx: DataFrame,
    factor: float = AMOUNT_FACTOR,
    method: str = "bands",
    keep_unknown: bool = True,
    hot_limit: int = HOT_LIMIT,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Count, mean, maximum, suspicious count and financial flag per client.

    Rows without a client form a group of their own, as in any ``GROUP BY``, but
    never count as suspicious: the mean they would be compared with is looked up
    by equality, which NULL does not satisfy. ``keep_unknown=False`` leaves that
    group out for callers that join it away anyhow.
    """
    rows = tx if keep_unknown else tx.where(F.col(CLIENT).isNotNull())
    if method == "bands":
        profile = _profile_by_bands(rows, factor, hot_limit)
    elif method == "salt":
        profile = _profile_by_salt(rows, factor, hot_limit, rows_per_salt)
    elif method == "local":
        profile = _profile_by_client(rows, factor)
    else:
        raise ValueError(f"method must be 'bands', 'salt' or 'local', not {method!r}")
    n, total, top = F.col("amount_count"), F.col("amount_sum"), F.col("max_transaction_amount")
    return profile.select(
        CLIENT,
        "total_transactions",
        mean(total, n).alias("avg_transaction_amount"),
        "max_transaction_amount",
        "suspicious_transaction_count",
        exceeds_mean(top, n, total, factor).alias("financial_risk"),
    )


def suspicious_count(tx: DataFrame, factor: float = AMOUNT_FACTOR, **options) -> DataFrame:
    """Rows per client above ``factor`` times the client's own mean."""
    return tx_profile(tx, factor, **options).select(CLIENT, "suspicious_transaction_count")


def login_profile(logins: DataFrame) -> DataFrame:
    return logins.groupBy(CLIENT).agg(F.count(F.lit(1)).alias("login_count"))
