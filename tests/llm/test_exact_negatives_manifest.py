"""Exact duplicates, hard negatives and the manifest against brute force: NULLs, ties, repeated rows, long texts, clashing columns."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.llm import hard_negatives, merkle, owners
from riskmart.llm.oracles import ORACLES
from riskmart.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp string, h string, data long, kids int, block long, name long, ids long, n long, hash long, hot string, `a.b` int"


def documents(count: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    words = ["Alpha", "beta", "é", "Ω\n", "x" * 40, "\n", " "]
    out = []
    for k in range(count):
        text = rng.choice([None, "", "same text", "SAME text", "long " * 9_000, "".join(rng.choices(words, k=rng.randint(1, 6)))])
        doc_id = None if rng.random() < 0.05 else rng.choice([k, k, k, rng.randint(0, count)])
        out.append((doc_id, text, rng.choice([None, "en", "fr"]), rng.choice([None, "", "b", "a", "é", "a"]), rng.choice([None, k])))
    return out + out[:7]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "g", "h", 1, 2, 3, 4, 5, 6, 7, "hot", 8) for r in rows], DOCS)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize(("keep", "options"), [("largest", {}), ("smallest", {}), ("largest", {"hash_mask": 1, "most": 20_000}), ("largest", {"hot_share": 1 << 40})])
def test_owners_equal_brute_force(spark, monkeypatch, keep, options):
    monkeypatch.setattr(owners, "SALTS", 2)  # so that a text of two rows is hot
    rows = documents(400, 1)
    got = owners.owners(frame(spark, rows).repartition(5), keep, **options).collect()
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(lowered(text), []).append(doc_id)
    pick = max if keep == "largest" else min
    owner = {t: pick((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    digest = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert sorted(map(repr, ((r["doc_id"], digest[r["text_sha256"]]) for r in got))) == sorted(map(repr, ((r[0], lowered(r[1])) for r in rows)))
    for r in got:
        text = digest[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"]) == (owner[text], len(groups[text]))
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert sorted(r["text_sha256"] for r in got if r["kept"]) == sorted(digest)


def test_owners_of_nothing(spark):
    assert owners.owners(frame(spark, [])).collect() == []


def test_trie_spills_by_subtree():
    rng = random.Random(3)
    keys = [bytes(rng.choices(b"ab", k=rng.randint(0, 14))) + b"tail" * rng.randint(0, 50) for _ in range(3_000)]
    trie = owners.Trie(lambda a, b: a + b, most=20_000)
    files = 0
    spill = trie._spill
    def counted():
        nonlocal files
        files += 1
        spill()
    trie._spill = counted
    for k in keys:
        trie.insert(k, 1)
    want = {}
    for k in keys:
        want[k] = want.get(k, 0) + 1
    found = list(trie.strings())
    assert dict(found) == want and len(found) == len(want) and files


VECTORS = "vec_id long, embedding array<float>, label int, at long, slot int, vector int, is_anchor string, score string"


def vectors(count: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for k in range(count):
        v = [rng.randint(-4, 9) / 8 for _ in range(rng.choice([3, 3, 3, 2]))]
        odd = rng.random()
        v = None if odd < 0.02 else [*v[:-1], None] if odd < 0.04 else [*v[:-1], float("nan")] if odd < 0.06 else [*v[:-1], float("-inf")] if odd < 0.08 else [] if odd < 0.1 else v
        out.append((None if rng.random() < 0.03 else k, v, None if rng.random() < 0.03 else rng.randint(0, 3)))
    return out + out[:20] + [(5, out[5][1], 2)]


def brute_negatives(rows, every, positives, negatives):
    sound = [(i, np.floor(256 * np.array(v, np.float64)), y) for i, v, y in rows if None not in (i, v, y) and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v, y in sound:
        if i % every:
            continue
        scored = sorted((-int(v @ w), j, z) for j, w, z in sound if len(w) == len(v))
        same = [(-s, j) for s, j, z in scored if z == y and j != i][:positives]
        for p, pid in same:
            fit = [(-s, j) for s, j, z in scored if z != y and 50 * p <= 100 * -s <= 95 * p][:negatives]
            out += [(i, pid, k + 1, j, p, s) for k, (s, j) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 3 * 8 * 7])
def test_hard_negatives_equal_brute_force(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 64)
    monkeypatch.setattr(hard_negatives, "TILE_ANCHORS", 5)
    rows = vectors(300, 2)
    table = spark.createDataFrame([(*r, 1, 2, 3, "x", "y") for r in rows], VECTORS).repartition(4)
    got = hard_negatives.mine(table, F.col("vec_id") % 10 == 0, block_bytes=block_bytes)
    want = brute_negatives(rows, 10, 5, 3)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 100


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(empty, F.col("vec_id") % 10 == 0).collect() == []
    alone = spark.createDataFrame([(0, [1.0], 1, 1, 2, 3, "x", "y")], VECTORS)
    assert hard_negatives.mine(alone, F.col("vec_id") % 10 == 0).collect() == []


def test_products_beyond_doubles_are_exact():
    a, b = hard_negatives.whole_numbers([[3e13, 1.0]], 256), hard_negatives.whole_numbers([[1.5, 2.0], [-1.0, 0.5]], 256)
    assert hard_negatives.products(a, b).tolist() == [[int(3e13) * 256 * 384 + 256 * 512, -int(3e13) * 256 * 256 + 256 * 128]]
    with pytest.raises(OverflowError):
        hard_negatives.products(hard_negatives.whole_numbers([[1e30]], 256), b[:, :1])


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    doc_id, text, lang, source, n_chars = row
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(leaves):
    """The root, and for each leaf its siblings left and right, level by level."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for k, path in enumerate(paths):
            low = at[k] // 3 * 3
            path.append(("".join(level[low : at[k]]), "".join(level[at[k] + 1 : low + 3])))
            at[k] //= 3
        level = [H(*level[k : k + 3]) for k in range(0, len(level), 3)]
    return (level or [None])[0], paths


@pytest.mark.parametrize(("count", "digits"), [(300, 2), (300, 6), (1, 6), (0, 6)])
def test_manifest_equals_brute_force(spark, monkeypatch, count, digits):
    monkeypatch.setattr(merkle, "DIGITS", digits)
    rows = documents(count, 4)
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, inner = [], {}
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        sub, paths = tree([leaf_of(r) for r in ordered])
        subroots.append(sub)
        inner[name] = (ordered, paths)
    root, outer = tree(subroots)
    want = sorted(
        (repr(r[0]), leaf_of(r), sub, root, repr(path + over))
        for name, sub, over in zip(names, subroots, outer, strict=True)
        for r, path in zip(*inner[name], strict=True)
    )
    made = merkle.manifest(frame(spark, rows).repartition(4), other=F.col("n_chars")).withColumn("folded", merkle.folded(F.col("leaf"), F.col("proof")))
    got = made.collect()
    assert sorted((repr(r["doc_id"]), r["leaf"], r["subroot"], r["root"], repr([tuple(s) for s in r["proof"]])) for r in got) == want
    assert all(r["folded"] == r["root"] for r in got)


@pytest.mark.parametrize("name", ["op11_owners", "op12_hard_negatives", "op13_merkle"])
def test_new_queries_equal_their_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(map(repr, (tuple(row) for row in df.select(*columns).collect())))
    assert got == sorted(map(repr, duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()))


def test_tampering_shows(spark, sf_dir, duck):
    """Every document that loses a line end fails, and no other does."""
    got = {r["doc_id"]: r["verified"] for r in QUERIES["op13_merkle"](spark, sf_dir).select("doc_id", "verified").collect()}
    texts = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    assert got == {i: not (zlib.crc32(str(i).encode()) % 2 == 0 and "\n" in (t or "")) for i, t in texts}
    assert len(set(got.values())) == 2


def test_sql_of_the_manifest_handles_small_tables():
    con = duckdb.connect()
    con.sql("CREATE TABLE documents AS SELECT 5::BIGINT AS doc_id, 'a'::VARCHAR AS text, NULL::VARCHAR AS lang, NULL::VARCHAR AS source, 1::BIGINT AS n_chars")
    (row,) = con.sql(ORACLES["op13_merkle"]).fetchall()
    assert row[1] == row[2] == row[3] == H("1:5", "-", "-", "1:1", "1:a")
