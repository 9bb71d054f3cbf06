"""Each operator against a plain version, over nulls, empty and repeated rows, ties and clashing columns."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parchment.llm import ann, bpe, counts, mixing, neardup, quality, substrings, suffixes, tokenfile, urlfilter
from parchment.llm.registry import oracle_sql, queries

from ..oracle import assert_same, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    make = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage, base = make(90), make(200)
    near = [*base[:60], "changed", *base[61:]]
    rows = [None, "", "  \n ", "few words", " ".join(base), " ".join(near), " ".join(base), " ".join(make(40) + passage + make(30)), "\n".join(passage + make(50)), " ".join(make(5) * 30), "x" * 3000, " ".join(make(4000))]
    return list(enumerate(rows)) + [(None, " ".join(make(60))), (3, "few words")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if (i or 0) % 2 else None, None if i == 2 else f"s{(i or 0) % 3}", 7, 8) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, gid int, key string")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert_same(queries()[name](spark, SF).toPandas(), connect(SF).execute(oracle_sql()[name]).df())


def test_bpe_tree_joins_to_the_plain_encoding(docs, texts):
    enc = bpe.encoding()
    found = rows_of(bpe.encode_documents(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = []
    for i, t in texts:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert found == sorted(want, key=repr)
    rng = random.Random(1)
    for _ in range(300):
        t = "".join(rng.choice(["a", " the", "'s", "  ", "\n", "é", "12", "!!", "\x1c", "　", " "]) for _ in range(60))
        assert bpe.encode_tree(t, enc.encode_ordinary, leaf=rng.choice([1, 3, 9])) == enc.encode_ordinary(t)


def test_token_files_round_trip(spark, docs, texts, tmp_path):
    tokenfile.write_tokens(docs, f"file://{tmp_path}/t")
    found = [(r.doc_id, r.start, list(r.ids)) for r in tokenfile.read_tokens(spark, f"file://{tmp_path}/t", with_ids=True).orderBy("start").collect()]
    plain = tokenfile.encoder(None).tokenizer
    at = 0
    for (doc_id, text), row in zip(sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0)), found, strict=True):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        assert row == (doc_id, at, ids)
        at += len(ids)


def test_packed_blocks_hold_any_numbers():
    for n in (0, 1, 255, 256, 257, 5000):
        ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32) >> np.random.default_rng(n).integers(0, 31, n).astype(np.uint32)
        assert (tokenfile.unpack(tokenfile.pack([None], [n], ids))[2] == ids).all()


def test_edits_keep_token_counts(docs):
    enc = bpe.encoding()
    for r in counts.count_documents(docs, counts.revision).join(docs.select(F.col("doc_id").alias("d"), "text").distinct(), F.col("doc_id").eqNullSafe(F.col("d"))).collect():
        text = r.text or ""
        for a, b, new in counts.revision(r.doc_id, text):
            a = min(a, len(text))
            text = text[:a] + new + text[max(a, min(b, len(text))) :]
        assert (r.n_tokens, r.tokens_after) == (len(enc.encode_ordinary(r.text or "")), len(enc.encode_ordinary(text)))


def test_repeated_word_windows(docs, texts):
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    seen, want = set(), []
    for i, t in order:
        w = (t or "").split()
        gone = set()
        for s in range(len(w) - 19):
            window = tuple(w[s : s + 20])
            if window in seen:
                gone |= set(range(s, s + 20))
            seen.add(window)
        want.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    assert rows_of(substrings.dedup_words(docs, 3), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=repr)


def test_shared_bytes(docs, texts, monkeypatch):
    plain = Counter(t[i : i + 400] for _, x in texts for t in [(x or "").encode()] for i in range(len(t) - 399))
    want = []
    for doc_id, x in texts:
        t = (x or "").encode()
        mask = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 399):
            if plain[t[i : i + 400]] > 1:
                mask[i : i + 400] = True
        left = bytes(b for b, g in zip(t, mask, strict=False) if not g)
        want.append((doc_id, len(t), int(mask.sum()), int((mask[1:] < mask[:-1]).sum()), hashlib.sha256(left).hexdigest()))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows_of(suffixes.dedup_bytes(docs, 3), *columns) == sorted(want, key=repr)
    monkeypatch.setattr("parchment.llm.repeats.HOT", 0)  # every minimizer takes the way of frequent ones
    assert rows_of(suffixes.dedup_bytes(docs, 3), *columns) == sorted(want, key=repr)


def test_near_duplicates(docs):
    found = {(r.doc_id, r.digest): r.class_id for r in neardup.near_duplicates(docs).collect()}
    classes = {k[0]: v for k, v in found.items()}
    assert classes[4] == classes[5] == classes[6] == 4
    assert [classes[i] for i in (0, 1, 2, 3, 7, 8, 9, 10, 11)] == [0, 1, 2, 3, 7, 8, 9, 10, 11]
    assert classes[None] is None


def test_alignment_equals_the_full_table():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(0, 14))] for _ in range(2))
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
        most = rng.randint(0, 14)
        assert neardup.alignment_distance(np.array(a), np.array(b), most) == min(d[-1], most + 1)


def test_quality_bounds_and_edges(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality.judge(docs, labels).collect()}
    assert kept[4] and not kept[0] and not kept[3] and not kept[9]
    p = spark.range(1).select(*[quality.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), 0.01) for k, n in ((0, 500), (3, 1000), (9, 1000))]).first()
    from math import comb

    for got, (k, n) in zip(p, ((0, 500), (3, 1000), (9, 1000)), strict=True):
        assert got == pytest.approx(sum(comb(n, i) * 0.01**i * 0.99 ** (n - i) for i in range(k + 1)), rel=1e-9)


def test_mix_reaches_targets(docs):
    rows = mixing.mix(docs).collect()
    assert all(0 <= r.taken <= 2 * r.size for r in rows) and len(rows) == docs.count()
    taken, target = Counter(), {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 2 for s in target)
    assert sum(len((r.text or "").split()) for r in mixing.mixed_documents(docs).collect()) == sum(taken.values())


def test_urls_of_every_shape(spark):
    pages = spark.createDataFrame([(1, None), (2, "nothing"), (3, "http://A.Example.com/en/1?x#y"), (4, "https://www.example.com/en/2"), (5, "http://b.net"), (None, "http://b.net/fr/9"), (6, "http://b.net/fr/9")], "page_id bigint, url string")
    none = spark.createDataFrame([], "url string, bad int")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, none).collect()}
    assert found[1] == found[2] == ("", "", None, "allow")
    assert found[3] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert found[4][2:] == ("www.example.com/en/", "allow")
    assert found[5] == ("b.net", "", None, "allow") and found[6][2:] == found[None][2:] == ("net/fr/", "block")


def test_neighbours_recall_and_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(rng.normal(size=(900, 16)))]
    rows += [(1000, None, 0), (1001, [0.0] * 16, 0), (1002, [float("nan")] * 16, 0), (1003, [None] * 16, 0), *[(2000 + i, rows[0][1], 0) for i in range(20)]]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, h int")
    got = ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), shard_size=300).collect()
    good = [(i, np.array(v)) for i, v, _ in rows if i < 1000 or i >= 2000]
    ids, x = np.array([g[0] for g in good]), np.array([g[1] for g in good])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = np.round(unit @ unit[q], 12)
        s[q] = -9
        best = ids[np.lexsort((ids, -s))[:5]].tolist()
        mine = [r.vec_id for r in sorted((r for r in got if r.query_id == ids[q]), key=lambda r: r.rank)]
        hits, total = hits + len(set(mine) & set(best)), total + 5
        if ids[q] == 0:
            assert mine == [2000, 2001, 2002, 2003, 2004]
    assert hits / total >= 0.9


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert bpe.encode_documents(none).count() == counts.count_documents(none, counts.revision).count() == 0
    assert substrings.dedup_words(none).count() == suffixes.dedup_bytes(none).count() == 0
    assert neardup.near_duplicates(none).count() == mixing.mix(none).count() == quality.judge(none, labels).count() == 0
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert ann.nearest(vectors, vectors).count() == 0


def test_classes_do_not_depend_on_the_size_of_squares(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(rng.choice("xyz") + w if rng.random() < 0.04 else w for w in base)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = rows_of(neardup.near_duplicates(docs), "doc_id", "class_id")
    plain = {i: i for i, _ in rows}
    for i, a in rows:
        for j, b in rows[:i]:
            if neardup.alike(a.encode(), b.encode()):
                x, y = sorted((plain[i], plain[j]))
                plain = {k: x if v == y else v for k, v in plain.items()}
    assert whole == sorted(plain.items(), key=repr)
    monkeypatch.setattr(neardup, "BLOCK", 7)
    assert rows_of(neardup.near_duplicates(docs), "doc_id", "class_id") == whole
