"""N-gram Jaccard join with adaptive multi-match prefixes, and the components of its links.

A document is the set of its distinct word shingles, in one global order: rarer first, by a frequency sketch of all
documents. If two sets of similarity t or more each keep their first n - ceil(t n) + l elements, they share l of them at
least. A longer prefix (larger l) means more postings and fewer candidates, so each document takes the l of least
estimated cost. A pair must share as many prefix elements as the smaller l of the two asks for, and is then verified.

Only the components of the links are needed, so pairs within a group of copies are not listed. Equal sets are one node.
At first the nodes meet in short lists of a few of their shared elements, and of a list only the edges of a spanning
forest of its likely links are verified, the closest first: fewer than it has nodes. Then nodes that are still in different
components are paired by all their shared elements, so that no link between components is left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.llm.components import connected_components
from riskmart.llm.tables import stored
from riskmart.llm.words import buffers, pieces, plain, shingle_sets

WIDTH = 5
#: Similarity as a percentage, so that comparisons are exact.
PERCENT = 75
#: Most elements that a pair is asked to share.
MOST_MATCHES = 8
#: What verifying a candidate costs, in postings read.
VERIFY_COST = 8.0
#: The sketch has 2 ** 20 counters whatever the input; it only orders elements and estimates costs.
SKETCH_BITS = 20
#: Nodes of one list.
LIST = 256
#: Ways to deal the nodes of an element over lists; two join what one way leaves apart.
DEALS = 2
#: Shared elements of a node by which it meets others at first; all others count in the pairing that follows.
FIRST_TOKENS = 8
#: Bits of the map that marks keys, 4 MB; with more keys it marks more rows than it has to.
MARK_BITS = 25
#: An element that this many documents may hold, beyond twice the average counter, has its postings dealt over tasks.
HOT = 20_000
#: Pairs of nodes compared in one step.
PAIRS_AT_ONCE = 1 << 18

U64 = np.uint64


def _counter(values: np.ndarray) -> np.ndarray:
    return (values >> U64(54 - SKETCH_BITS)).astype(np.int64)


def frequency_sketch(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    """How many documents have a shingle in each counter: an upper bound for a shingle's documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for part in pieces(batch, "text"):
                values, _ = shingle_sets(part.column("text"), width)
                total += np.bincount(_counter(values), minlength=len(total))
        if total.any():
            blocks = total.reshape(64, -1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(64)), pa.array([zlib.compress(b.tobytes(), 1) for b in blocks], pa.binary())], ["block", "counts"])

    def add(block: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(b), np.int64) for b in block.column("counts").to_pylist())
        return pa.table({"block": block.column("block").slice(0, 1), "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    summed = docs.select("text").mapInArrow(count, "block long, counts binary").groupBy("block").applyInArrow(add, "block long, counts binary")
    out = np.zeros((64, (1 << SKETCH_BITS) // 64), np.int64)
    for row in summed.collect():  # always 64 rows of fixed size
        out[row["block"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return np.minimum(out.ravel(), 2**31 - 1).astype(np.int32)


def prefixes(values: np.ndarray, ptr: np.ndarray, sketch: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Prefix elements, their pointer, their counters and each set's l."""
    n = np.diff(ptr)
    owner = np.repeat(np.arange(len(n)), n)
    seen = sketch[_counter(values)].astype(np.int64)
    rank = np.floor(np.log2(np.maximum(seen, 1))).astype(np.int64)
    order = np.argsort(owner * 64 + rank, kind="stable")  # elements are in ascending order already
    values, seen = values[order], seen[order]
    need = -(-n * percent // 100)
    total = np.concatenate([[0], np.cumsum(seen)])
    best = np.full(len(n), np.inf)
    chosen = np.ones(len(n), np.int64)
    for matches in range(1, MOST_MATCHES + 1):
        possible = need >= matches
        end = ptr[:-1] + np.minimum(n - need + matches, n)
        cost = (total[end] - total[ptr[:-1]]) * (1 + VERIFY_COST / matches)
        better = possible & (cost < best)
        best[better], chosen[better] = cost[better], matches
    length = np.where(n > 0, np.minimum(n - need + chosen, n), 0)
    out_ptr = np.concatenate([[0], np.cumsum(length)])
    at = np.repeat(ptr[:-1] - out_ptr[:-1], length) + np.arange(out_ptr[-1])
    return values[at], out_ptr, seen[at], chosen


def set_keys(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set."""
    return np.array([xxhash.xxh3_64_intdigest(values[s:e].tobytes()) for s, e in zip(ptr[:-1], ptr[1:], strict=True)], U64).view(np.int64)


def _prefix_rows(docs: DataFrame, sketch: np.ndarray, width: int, percent: int, hot: int) -> DataFrame:
    """doc_id, node (name of the set), n, matches, the prefix as lists of elements and of the lists that each may fill
    (0 unless hot), and the parity sketch."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    most = hot + 2 * int(sketch.mean())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for part in pieces(batch, "text"):
                values, ptr = shingle_sets(part.column("text"), width)
                kept, out_ptr, seen, matches = prefixes(values, ptr, counts, percent)
                lists = np.where(seen > most, -(-seen // LIST), 0).astype(np.int32)
                offsets = pa.array(out_ptr, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(set_keys(values, ptr)),
                        pa.array(np.diff(ptr)),
                        pa.array(matches),
                        pa.ListArray.from_arrays(offsets, pa.array(kept.view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(lists)),
                        pa.array(parity_sketches(values, ptr), pa.binary()),
                    ],
                    ["doc_id", "node", "n", "matches", "tokens", "lists", "sketch"],
                )

    return docs.mapInArrow(run, "doc_id long, node long, n long, matches long, tokens array<long>, lists array<int>, sketch binary")


def verified(pairs: DataFrame, texts: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar enough; texts are (node, text)."""
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for outer in pieces(batch, "text_a"):
                for part in pieces(outer, "text_b"):
                    b = part.column("b").to_numpy()
                    new = np.ones(len(b), bool)
                    new[1:] = b[1:] != b[:-1]  # rows come in order of b, so its set is made once
                    of = np.cumsum(new) - 1
                    va, pa_ = shingle_sets(part.column("text_a"), width)
                    vb, pb = shingle_sets(part.column("text_b").filter(pa.array(new)), width)
                    keep = np.zeros(len(b), bool)
                    for k in range(len(b)):
                        x, y = va[pa_[k] : pa_[k + 1]], vb[pb[of[k]] : pb[of[k] + 1]]
                        if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
                            continue
                        at = np.searchsorted(y, x)
                        at[at == len(y)] = 0
                        common = int((y[at] == x).sum()) if len(y) else 0
                        keep[k] = common > 0 and 100 * common >= percent * (len(x) + len(y) - common)
                    yield part.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(run, "a long, b long")


def marked(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows with a column `marked`: true where `column` has a value that keys has (NULL too), and for a few others.

    Spreads a bitmap of bounded size to all tasks, so that rows that are not wanted stay out of a shuffle.
    """
    place = F.pmod(F.xxhash64(F.col(column)), F.lit(1 << MARK_BITS))
    block, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    maps = keys.groupBy(block.alias("mark_block")).agg(F.bitmap_construct_agg(bit).alias("mark_bits"))
    byte = F.conv(F.hex(F.col("mark_bits").substr((F.col("mark_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    found = F.coalesce(F.getbit(byte, F.pmod(F.col("mark_bit"), F.lit(8))) == 1, F.lit(False))
    placed = rows.withColumns({"mark_block": block, "mark_bit": bit}).join(F.broadcast(maps), "mark_block", "left")
    return placed.select(*rows.columns, found.alias("marked"))


def texts_of(docs: DataFrame, nodes: DataFrame, names) -> DataFrame:
    """node, text of these nodes (node, doc_id); names gives the names of texts.

    Rows are taken by a map of the ids, NULL among them, and then met by name, as an id may stand for several texts.
    Only texts of marked ids are named and shuffled, once.
    """

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(names(part.column("text"))), part.column("text")], ["node", "text"])

    wanted = marked(docs.select("doc_id", "text"), nodes, "doc_id").filter("marked").select("text")
    return wanted.mapInArrow(named, "node long, text string").join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])


def parity_sketches(values: np.ndarray, ptr: np.ndarray) -> list[bytes]:
    """For each set 512 bits, each the parity of its elements there: two sets differ in at least as many elements as bits."""
    owner = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    n = np.bincount(owner * 512 + (values & U64(511)).astype(np.int64), minlength=(len(ptr) - 1) * 512)
    return [row.tobytes() for row in np.packbits((n & 1).astype(np.uint8).reshape(-1, 512), axis=1)]


def _members(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Where each list begins, its length, and the members' fields, 'sketch' as rows of 64-bit words."""
    rows = column.values
    fields = [rows.type.field(k).name for k in range(rows.type.num_fields)]
    out = {n: rows.field(n).to_numpy(zero_copy_only=False) for n in fields if n != "sketch"}
    sketch, ptr = buffers(rows.field("sketch"))
    out["sketch"] = np.frombuffer(sketch.tobytes(), U64).reshape(len(ptr) - 1, -1)
    offsets = column.offsets.to_numpy().astype(np.int64)
    return offsets[:-1], np.diff(offsets), out


def similar(percent: int):
    """Which of the pairs of members can be similar enough, by their sizes and parity sketches."""

    def near(x: dict[str, np.ndarray], y: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        n, m = x["n"][i], y["n"][j]
        out = (n * 100 >= percent * m) & (m * 100 >= percent * n)
        left = np.flatnonzero(out)
        apart = np.bitwise_count(x["sketch"][i[left]] ^ y["sketch"][j[left]]).sum(1, dtype=np.int64)
        out[left] = apart * (100 + percent) <= (n[left] + m[left]) * (100 - percent)
        return out

    return near


def spanning_forest(one: np.ndarray, two: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Which edges (one, two) make up the spanning forest of least total `apart`, by rounds of closest edges per tree."""
    edges = np.lexsort((two, one, apart))  # a place in this order breaks ties, so that the closest edges make no cycle
    ends, at = np.unique(np.concatenate([one[edges], two[edges]]), return_inverse=True)
    x, y = at[: len(edges)], at[len(edges) :]
    tree = np.arange(len(ends))
    chosen = []
    left = np.arange(len(edges))
    while True:
        left = left[tree[x[left]] != tree[y[left]]]
        if not len(left):
            return edges[np.concatenate(chosen)] if chosen else left
        closest = np.full(len(ends), len(edges))
        for side in (tree[x[left]], tree[y[left]]):
            own = np.full(len(ends), len(edges))
            own[side[::-1]] = left[::-1]  # the first edge of each tree is written last
            closest = np.minimum(closest, own)
        roots = np.flatnonzero(closest < len(edges))
        picked = closest[roots]
        chosen.append(np.unique(picked))
        to = np.arange(len(ends))
        to[roots] = tree[x[picked]] + tree[y[picked]] - roots
        mutual = (to[to] == np.arange(len(ends))) & (np.arange(len(ends)) < to)
        to[mutual] = np.flatnonzero(mutual)
        while not np.array_equal(to, to[to]):
            to = to[to]
        tree = to[tree]


def _forests(near):
    """(a, b) of the edges of each list's spanning forest, among the pairs that are near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, size, x = _members(batch.column("members"))
            total = np.concatenate([[0], np.cumsum(size * size)])
            low = 0
            while low < batch.num_rows:  # as many rows as have PAIRS_AT_ONCE pairs; each has few, as lists are short
                high = max(low + 1, int(np.searchsorted(total, total[low] + PAIRS_AT_ONCE, "right")) - 1)
                row = np.repeat(np.arange(low, high), np.diff(total[low : high + 1]))
                at = np.arange(total[low], total[high]) - total[row]
                low = high
                i, j = start[row] + at // size[row], start[row] + at % size[row]
                fits = i < j
                i, j = i[fits], j[fits]
                fits = near(x, x, i, j)
                i, j = i[fits], j[fits]
                apart = np.bitwise_count(x["sketch"][i] ^ x["sketch"][j]).sum(1, dtype=np.int64)
                kept = spanning_forest(i, j, apart)
                if len(kept):
                    edges = np.unique(np.sort(np.stack([x["node"][i[kept]], x["node"][j[kept]]]), axis=0), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(edges[0]), pa.array(edges[1])], ["a", "b"])

    return run


def closest_pairs(postings: DataFrame, nodes: DataFrame, near) -> DataFrame:
    """Pairs (a, b) of nodes, fewer than the nodes of each token: a spanning forest of each of its lists.

    postings: token, node, lists (of the token); nodes: node, n, sketch. A node takes part with the FIRST_TOKENS of its
    tokens that come first by a hash; nodes alike mostly agree on these. Nodes meet in the same lists of many tokens, so
    that few different pairs come out, but not in the same of all, so that large groups do not fall apart.
    """
    order = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("token"), "token"))
    postings = postings.withColumn("order", order).filter(F.col("order") <= FIRST_TOKENS).drop("order")
    part = F.pmod(F.xxhash64("node", F.pmod("token", F.lit(DEALS))), F.col("lists")).alias("part")
    lists = postings.join(nodes, "node").groupBy("token", part).agg(F.collect_list(F.struct("node", "n", "sketch")).alias("members"))
    return lists.filter("size(members) > 1").select("members").mapInArrow(_forests(near), "a long, b long").distinct()


def _met(near):
    """(a, b, need) of the pairs of two lists that lie in different components and are near; many rows at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (from_a, size_a, x), (from_b, size_b, y) = (_members(batch.column(c)) for c in ("m_a", "m_b"))
            same = batch.column("part_a").to_numpy() == batch.column("part_b").to_numpy()
            total = np.concatenate([[0], np.cumsum(size_a * size_b)])
            low = 0
            while low < batch.num_rows:  # as many rows as have PAIRS_AT_ONCE pairs; each has few, as lists are short
                high = max(low + 1, int(np.searchsorted(total, total[low] + PAIRS_AT_ONCE, "right")) - 1)
                row = np.repeat(np.arange(low, high), np.diff(total[low : high + 1]))
                at = np.arange(total[low], total[high]) - total[row]
                i, j = from_a[row] + at // size_b[row], from_b[row] + at % size_b[row]
                fits = (x["component"][i] != y["component"][j]) & (~same[row] | (x["node"][i] < y["node"][j]))
                i, j, row = i[fits], j[fits], row[fits]
                if len(i):
                    fits = near(x, y, i, j)
                    i, j, row = i[fits], j[fits], row[fits]
                low = high
                if len(i):
                    one, two = x["node"][i], y["node"][j]
                    columns = np.stack([row, np.minimum(one, two), np.maximum(one, two), np.minimum(x["matches"][i], y["matches"][j])])
                    columns = np.unique(columns, axis=1)[1:]  # a node may be in a list more than once
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["a", "b", "need"])

    return run


def with_component(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows (node, ...) with their component; a node without a label is its own."""
    return rows.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def mixed_postings(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings whose token has nodes of several components, with their component and the number of lists of the token."""
    return in_lists(stored(with_component(postings, labels).select(*postings.columns, "component")))


def in_lists(named: DataFrame) -> DataFrame:
    """The postings, stored with their component, whose token has several components, with the number of its lists."""
    mixed = named.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).filter("low < high")
    return named.join(mixed.select("token", F.ceil(F.col("size") / LIST).alias("lists")), "token")


def pairs_across(mixed: DataFrame, near) -> DataFrame:
    """Pairs (a, b) of nodes in different components that are near in as many tokens as the smaller `matches` asks for.

    mixed: token, node, n (size), matches, component, lists, sketch; near says which pairs of members to keep, and is asked
    before a pair is emitted. Nodes of a token meet in lists of bounded length, so neither a frequent token nor a large
    component is handled as a whole. A token with one list needs no second shuffle.
    """
    part = F.pmod(F.xxhash64("node"), F.col("lists")).alias("part")
    members = F.collect_list(F.struct("node", "n", "matches", "component", "sketch")).alias("members")
    alone = mixed.filter("lists = 1").groupBy("token").agg(members)
    one_list = alone.select(*(F.lit(0).cast("long").alias(f"part_{x}") for x in "ab"), *(F.col("members").alias(f"m_{x}") for x in "ab"))
    lists = mixed.filter("lists > 1").groupBy("token", part).agg(members)
    a, b = (lists.select("token", F.col("part").alias(f"part_{x}"), F.col("members").alias(f"m_{x}")) for x in "ab")
    two_lists = a.join(b, "token").filter("part_a <= part_b").select("part_a", "part_b", "m_a", "m_b")
    met = one_list.unionByName(two_lists).mapInArrow(_met(near), "a long, b long, need long")
    return met.groupBy("a", "b").agg(F.count("*").alias("shared"), F.first("need").alias("need")).filter("shared >= need").select("a", "b")


def _links(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """src, dst of the pairs that are links. Only their texts are fetched."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = stored(nodes.select("node", "doc_id").join(ends, "node", "left_semi"))
    texts = texts_of(rows, wanted, lambda texts: set_keys(*shingle_sets(texts, width)))
    return stored(verified(pairs, texts, width, percent).select(F.col("a").alias("src"), F.col("b").alias("dst")))


def link_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, hot: int = HOT) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that links reach; one row per row of docs.

    Texts without words (NULL, empty, spaces) have no shingles, link with nothing and are their own component. Shorter
    texts are one shingle. Equal texts and rows that repeat an id share a component. A NULL doc_id takes part with its
    text but never names a component that has another id. An empty table gives an empty one.
    """
    rows = plain(docs, "doc_id", "text")
    made = stored(_prefix_rows(rows, frequency_sketch(rows, width), width, percent, hot))
    sets = made.filter("n > 0")
    nodes = stored(sets.groupBy("node").agg(*(F.min(c).alias(c) for c in ("doc_id", "n", "matches", "sketch")), F.count("*").alias("copies")))
    # equal sets have equal prefixes; only sets that may occur more than once have to meet for one of them to stay
    prefix = marked(sets.select("node", F.struct("tokens", "lists").alias("own")), nodes.filter("copies > 1"), "node")
    once = prefix.filter("marked").groupBy("node").agg(F.first("own").alias("own"))
    own = prefix.filter("NOT marked").select("node", "own").unionByName(once)
    exploded = own.select("node", F.explode(F.arrays_zip("own.tokens", "own.lists")).alias("t"))
    salted = exploded.select("node", F.col("t.tokens").alias("token"), F.col("t.lists").alias("most"))
    salt = F.when(F.col("most") > 0, F.pmod(F.xxhash64("node"), F.col("most"))).otherwise(F.lit(0))
    counted = salted.withColumn("size", F.count("*").over(Window.partitionBy("token", salt)))
    lists = F.when(F.col("most") > 0, F.col("most")).otherwise(F.ceil(F.col("size") / LIST)).cast("long").alias("lists")
    postings = stored(counted.filter("most > 0 OR size > 1").select("token", "node", lists))

    near = similar(percent)
    pairs = stored(closest_pairs(postings, nodes.select("node", "n", "sketch"), near))
    links = _links(pairs, nodes, rows, width, percent)
    members = postings.select("token", "node")
    found = connected_components(links)
    mixed = stored(mixed_postings(members, found)).join(nodes.select("node", "n", "matches", "sketch"), "node")
    across = stored(pairs_across(mixed, near))
    stars = found.select(F.col("node").alias("src"), F.col("component").alias("dst"))
    labels = connected_components(stars.unionByName(_links(across, nodes, rows, width, percent)))
    ids = nodes.select("node", F.col("doc_id").alias("least"))
    named = with_component(ids, labels)
    smallest = named.groupBy("component").agg(F.min("least").alias("smallest"))
    names = named.join(smallest, "component").select("node", "smallest")
    out = made.select("doc_id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(names, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, with all their columns, less near-duplicates: of each component the document of smallest doc_id.

    Of rows that repeat an id with the same text one stays; rows without an id all stay, as nothing tells them apart.
    """
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("`doc_id`").cast("long").alias("id"), F.col("`text`").alias("body"))
    groups = link_components(plain(docs, "doc_id", "text").filter(F.col("doc_id").isNotNull()), width, percent)
    heads = groups.filter("doc_id = component_id").select(F.col("doc_id").alias("id")).distinct()
    kept = row.filter("id IS NOT NULL").join(heads, "id", "left_semi").select("row", "id", "body")
    once = kept.withColumn("digest", F.xxhash64("body")).dropDuplicates(["id", "digest"]).select("row")
    return once.unionByName(row.filter("id IS NULL").select("row")).select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
