"""Training-data operators against brute force, and on nulls, empty and repeated rows, clashing columns and empty tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from notara.llm import _ctw, _minhash, _parcels, _text, bpe, exact_dedup, language_id, lm_score, mixing, near_dedup, quality, substring_dedup, token_counts, toxicity
from notara.llm.components import connected_components

W = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("h", "row", "key", "n", "size", "kept", "component_id", "maybe", "score", "parcel", "shard", "page", "m", "doc", "rep")


def prose(rng, n, words=60):
    return " ".join(rng.choice(WORDS) for _ in range(n))


WORDS = [f"{a}{b}" for a in ("ba", "ke", "li", "mo", "nu", "ra", "so", "ti") for b in ("", "den", "lor", "mas", "pe", "Qu", "é")]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    base = [prose(rng, 80) for _ in range(12)]
    for i, t in enumerate(base):
        out.append((i, t, "en", "a"))
    for i in range(12, 30):  # near copies, exact copies, a shared passage
        t = base[i % 6].split(" ")
        if i % 3 == 0:
            t[rng.randrange(80)] = "changed"
        elif i % 3 == 1:
            t = prose(rng, 30).split(" ") + base[11].split(" ")[10:60]
        out.append((i, " ".join(t), ("en", "de")[i % 2], ("a", "b", None)[i % 3]))
    out += [(30, None, None, None), (31, "", "en", "b"), (32, " \n\t", "de", "a"), (33, "one", "en", "a"), (34, "One", None, "b"), (35, "a\r\n b", "en", "c"), (36, "a b", "en", "c"), (None, "no id", "en", "a")]
    out += [out[0], (37, "x " * 400, "en", "a"), (38, " ".join(prose(rng, 50) for _ in range(60)), "de", "b"), (39, "!!! ??? 123", "en", "a"), (40, "é中\U0001f600 <|endoftext|> z", "fr", "b")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    for c in CLASH:
        df = df.withColumn(c, F.lit("x"))
    return df.repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# ---- kernels ------------------------------------------------------------------------------------


def test_words_and_hashes():
    import pyarrow as pa

    texts = ["a bb  ccc", None, "", " \t", "x\ny", "A bb", "é"]
    got = [(w.data[s:e].tobytes().decode(), i) for w in _text.pieces(pa.array(texts), 4) for s, e, i in zip(w.starts, w.ends, np.searchsorted(w.first, np.arange(len(w.starts)), "right") - 1 + w.lo)]
    assert got == [(x, i) for i, t in enumerate(texts) for x in W.findall(t or "")]
    h = {x: next(iter(_text.pieces(pa.array([x])))).hashes()[0] for x in ("a", "A", "bb", "b")}
    assert len(set(h.values())) == 4
    low = next(iter(_text.pieces(pa.array(["a A B b"])))).hashes(True)
    assert low[0] == low[1] and low[2] == low[3] != low[0]


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 62, 600).astype(np.uint64))
    b = np.unique(np.concatenate((a[:450], rng.integers(0, 1 << 62, 150).astype(np.uint64))))
    s = _minhash.signatures([a, b], 2000)
    true = _minhash.overlap(a, b) / (len(a) + len(b) - _minhash.overlap(a, b))
    assert abs((s[0] == s[1]).mean() - true) < 0.05


def test_components(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 400)] + [(5, 5), (None, 3), (1, 2), (2, 1)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 10 for i in range(10, 41)) and all(got[i] == 100 for i in range(100, 400)) and got[2] == got[1] == 1 and 5 not in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_context_tree_is_a_distribution():
    data = np.frombuffer(b"abracadabra abracadabra", np.uint8)
    g, _ = _ctw.grams(data, np.array([0, len(data)]), 3)
    tree = _ctw.Tree(*np.unique(g, return_counts=True), 3)
    for context in (b"abr", b"zzz", b"\0\0a"):
        c = int.from_bytes(context, "big") << 8
        p = 2.0 ** tree.score(np.arange(256, dtype=np.uint64) + np.uint64(c))
        assert abs(p.sum() - 1) < 1e-6
    # depth 0 is the plain estimate
    flat = _ctw.Tree(np.array([65], np.uint64), np.array([3]), 0)
    assert abs(2.0 ** flat.score(np.array([65], np.uint64))[0] - (3.5 / 4) ** 8) < 1e-5


# ---- operators ----------------------------------------------------------------------------------


def test_near_duplicates(docs, rows, nothing):
    sets = {}
    for d, t, *_ in rows:
        w = W.findall((t or "").translate(LOW))
        sets[d] = frozenset(" ".join(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([" ".join(w)] if w else [])
    ids = sorted(d for d in sets if d is not None)
    root = {d: d for d in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                i = len(sets[a] & sets[b])
                if i and 100 * i >= 75 * len(sets[a] | sets[b]) and root[b] > root[a]:
                    root[b], changed = root[a], True
    got = by_id(near_dedup.near_duplicates(docs))
    assert {d: got[d]["component_id"] for d in ids} == root and all(got[d]["kept"] == (root[d] == d) and got[d]["n_shingles"] == len(sets[d]) for d in ids)
    assert got[None]["component_id"] is None and got[None]["kept"]
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_exact_groups(docs, rows, nothing):
    group = collections.defaultdict(list)
    for d, t, *_ in rows:
        group[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    got = collections.defaultdict(list)
    for r in exact_dedup.text_groups(docs).collect():
        got[r["doc_id"]].append(r)
    for t, ids in group.items():
        for d in ids:
            for r in got[d]:
                assert r["keep_id"] == min((x for x in ids if x is not None), default=None) and r["group_size"] == len(ids) and r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert sum(r["kept"] for x in got.values() for r in x) == len(group) == exact_dedup.drop_copies(docs).count()
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and exact_dedup.text_groups(nothing).count() == exact_dedup.drop_copies(nothing).count() == 0


def test_repeated_passages(docs, rows, nothing):
    words = [W.findall(t or "") for _, t, *_ in rows]
    count = collections.Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    want = collections.Counter()
    for (d, *_), w in zip(rows, words, strict=True):
        gone = {j for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        want[d, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in substring_dedup.repeated_passages(docs).collect()) == want
    assert any(n for _, _, n, _ in want) and substring_dedup.repeated_passages(nothing).count() == 0


def test_sketch_in_shards(docs, monkeypatch):
    """A sketch that is too large to broadcast is looked up in shards, with the same result; pages may span shards or share one."""
    want = sorted(tuple(r) for r in substring_dedup.repeated_passages(docs.where("doc_id IS NOT NULL")).collect())
    monkeypatch.setattr(substring_dedup, "MOST_CELLS", 1)
    assert sorted(tuple(r) for r in substring_dedup.repeated_passages(docs.where("doc_id IS NOT NULL")).collect()) == want
    width = 1 << 20
    sent = substring_dedup._sharded(docs.where("doc_id IS NOT NULL").select("doc_id", "text"), width, 35, 16, 3)
    again = _parcels.answer(sent, None, substring_dedup._reply, substring_dedup._finish(35), bool, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    assert sorted(tuple(r) for r in again.collect()) == want
    key = np.random.default_rng(1).integers(0, 1 << 62, 500).astype(np.uint64)
    asked = substring_dedup._lookups(key, width)
    assert (np.diff(np.sort(asked) >> np.uint64(43)) >= 0).all() and (asked >> np.uint64(43) < 2 * width).all()
    cell = [substring_dedup.cells(key, r, width) for r in range(2)]
    assert ((asked >> np.uint64(43)).astype(np.int64) == np.concatenate((cell[0], cell[1] + width))).all() and max(map(max, cell)) < width


def test_sketch_never_underestimates():
    import pyarrow as pa

    rng = random.Random(3)
    part = prose(rng, 60)
    (p,) = _text.pieces(pa.array([prose(rng, 50) + " " + part, part + " " + prose(rng, 70), "| " * 90]))
    place, key, counted = substring_dedup.windows(p, p.hashes(), 35, 16)
    whole = _text.rolled(p.hashes(), 35)[place]
    n, k = collections.Counter(whole.tolist()), collections.Counter(counted.tolist())
    assert all(k[b] >= n[a] for a, b in zip(whole.tolist(), key.tolist(), strict=True)) and max(n.values()) > 1


def test_mixing(docs, rows, nothing):
    d = docs.select("doc_id", "source", mixing.n_words().alias("size"))
    got = mixing.mix(d).collect()
    again = mixing.mix(d).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["n_copies"], r["size"])
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    total = sum(len(W.findall(t or "")) for _, t, *_ in rows)
    target = {r["source"]: (r["target"], r["source_size"]) for r in got}
    assert abs(sum(t for t, _ in target.values()) - 1.5 * total) < 1e-6 and all(t <= 2 * s + 1e-9 for t, s in target.values())
    taken = collections.Counter()
    for r in got:
        assert 0 <= r["n_copies"] <= 2
        taken[r["source"]] += r["size"] * r["n_copies"]
    longest = max(r["size"] for r in got)
    assert sum(taken.values()) <= 1.5 * total and all(abs(taken[s] - t) <= 2 * longest for s, (t, _) in target.items())
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r["n_copies"] for r in got)
    assert mixing.mix(nothing.select("doc_id", "source", F.lit(1).cast("long").alias("size"))).count() == 0 == mixing.mixed_documents(nothing).count()


def test_bpe(docs, rows, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = collections.defaultdict(list)
    for r in bpe.encoding_digests(docs).collect():
        got[r["doc_id"]].append(r)
    for d, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        for r in got[d]:
            assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    back = by_id(bpe.decode_documents(bpe.encode_documents(docs)))
    assert all(back[d]["text"] == (text or "") for d, text, *_ in rows)
    assert bpe.encoding_digests(nothing).count() == 0


def test_bpe_fuzz():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t, e, rng = Tokenizer.from_file(path), bpe.Encoder(path), random.Random(2)
    pool = [chr(c) for c in [*range(0, 0x180), *range(0x2000, 0x2030), 0x3000, 0x4E2D, 0x1F600, 0x301, 0xB2]] + ["'s", "'ll", "<|endoftext|>", "aaa", "    ", "\n\n", " the"] * 20
    for _ in range(1500):
        s = "".join(rng.choice(pool) for _ in range(rng.randrange(40)))
        assert e.encode(s) == t.encode(s, add_special_tokens=False).ids


def test_token_counts(docs, rows, nothing):
    got = collections.defaultdict(list)
    for r in token_counts.section_token_counts(docs.where("doc_id IS NULL OR doc_id != 0")).collect():
        got[r["doc_id"]].append(r)
    for d, text, *_ in rows:
        if d == 0:
            continue
        parts = sorted(got[d], key=lambda r: r["section"])
        want = (text or "").split("\n")
        assert len(parts) == max(1, len(want) - (not want[-1]))
        assert sum(r["n_tokens"] for r in parts) == parts[0]["doc_tokens"] and parts[-1]["end"] == len(text or "")
    starts, ends, cuts = np.array([0, 3, 5]), np.array([3, 5, 9]), np.array([0, 4, 8])
    assert token_counts.allot(starts, ends, cuts, 9, "start")[0].tolist() == [0, 0, 1]
    assert token_counts.allot(starts, ends, cuts, 9, "end")[0].tolist() == [0, 1, 2]
    assert token_counts.allot(starts, ends, cuts, 9, "most")[0].tolist() == [0, 0, 1]
    with pytest.raises(ValueError):
        token_counts.section_token_counts(docs, rule="none")
    assert token_counts.section_token_counts(nothing).count() == 0


def test_lm_scores(docs, rows, nothing):
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    df = docs.select("doc_id", "text", (F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7, F.lit(0)) == 2).alias("held_out"))
    c, n = collections.Counter(), 0
    for d, t, *_ in rows:
        if not held(d):
            c.update([*W.findall((t or "").translate(LOW)), None])
    total, kinds = sum(c.values()), len(c)
    got = collections.defaultdict(list)
    for r in lm_score.lm_scores(df, df.where("NOT held_out")).collect():
        got[r["doc_id"]].append(r)
    for d, t, *_ in rows:
        tokens = [*W.findall((t or "").translate(LOW)), None]
        base = sum(math.log10((c[x] + 1) / (total + kinds + 1)) for x in tokens)
        for r in got[d]:
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(d), len(tokens), sum(c[x] > 0 for x in tokens), total)
            assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0
            assert r["n_bytes"] == len((t or "").encode()) + 1 and math.isclose(r["bits_per_byte"], -r["score"] / math.log10(2) / r["n_bytes"], rel_tol=1e-9)
        n += 1
    assert sum(map(len, got.values())) == n
    assert lm_score.lm_scores(df.limit(0), df).count() == 0
    untrained = lm_score.lm_scores(df.where("doc_id = 33"), df.limit(0)).first()
    assert untrained["n_known"] == 0 and math.isclose(untrained["score"], -4 * 8 * math.log10(2), rel_tol=1e-6)


def test_lm_rare_words_go_through_shards(docs, monkeypatch):
    """With almost no frequent words every count comes from the shards, and nothing changes."""
    df = docs.select("doc_id", "text", F.lit(False).alias("held_out"))
    want = sorted((r["doc_id"] or -1, r["n_known"], round(r["base_score"], 9)) for r in lm_score.lm_scores(df, df).collect())
    monkeypatch.setattr(lm_score, "FREQUENT", 3)
    assert sorted((r["doc_id"] or -1, r["n_known"], round(r["base_score"], 9)) for r in lm_score.lm_scores(df, df).collect()) == want


def test_lm_contexts_keep_their_length(spark, monkeypatch):
    """Context-tree weighting over the operator's depth, gram by gram, however few grams may be broadcast."""
    deep = lm_score.DEPTH
    assert deep >= 3
    rng = random.Random(8)
    train, other = [prose(rng, 40).lower() for _ in range(12)], [prose(rng, 30).lower() + " zq\u4e2d", "", "qqq"]
    counts = collections.defaultdict(lambda: [0, 0])
    contexts = collections.defaultdict(set)

    def walk(text):
        data = b"\0" * deep + text.encode() + b"\0"
        for i in range(deep, len(data)):
            for k in range(8):
                yield [(data[i - d : i], (1 << k) | (data[i] >> (8 - k))) for d in range(deep + 1)], (data[i] >> (7 - k)) & 1

    for t in train:
        for path, bit in walk(t):
            for node, child in zip(path, path[1:] + [None]):
                counts[node][bit] += 1
                if child:
                    contexts[node].add(child)
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    weighted, share = {}, {}
    for node in sorted(counts, key=lambda x: -len(x[0])):
        own = kt(*counts[node])
        if len(node[0]) == deep:
            weighted[node], share[node] = own, 1.0
        else:
            longer = sum(weighted[x] for x in contexts[node])
            top = max(own, longer)
            weighted[node] = top + math.log(math.exp(own - top) + math.exp(longer - top)) - math.log(2)
            share[node] = 1 / (1 + math.exp(min(700, longer - own)))
    want = []
    for t in train + other:
        total = 0.0
        for path, bit in walk(t):
            p, met = 0.5, False
            for node in reversed(path):
                if node in counts:
                    a, b = counts[node]
                    w = share[node] if met else 1.0
                    p, met = w * (b + 0.5) / (a + b + 1) + (1 - w) * p, True
            total += math.log10(p if bit else 1 - p)
        want.append(total)
    df = spark.createDataFrame([(i, t, False) for i, t in enumerate(train + other)], "doc_id long, text string, held_out boolean").repartition(3)
    for most in (None, 3):
        if most:  # nearly all grams are looked up; MOST_GRAMS was the bound that made contexts shorter
            for name in ("MOST_GRAMS", "FREQUENT_GRAMS"):
                monkeypatch.setattr(lm_score, name, most, raising=False)
        got = by_id(lm_score.lm_scores(df, df.where(f"doc_id < {len(train)}")))
        assert all(math.isclose(got[i]["score"], x, rel_tol=1e-5) for i, x in enumerate(want))


def test_quality_counts(docs, rows, nothing):
    got = collections.defaultdict(list)
    for r in quality.quality(docs).collect():
        got[r["doc_id"]].append(r)
    for d, t, *_ in rows:
        t = t or ""
        w = W.findall(t)
        five = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        again = {j for i in range(len(w) - 4) if five[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if W.search(x)]
        want = (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(again))
        for r in got[d]:
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
            assert r["base_failed"] == (len(w) < 10 or 100 * len(again) > 20 * len(w)) and (not r["base_failed"] or not r["kept"])
    assert quality.quality(nothing).count() == 0


def test_quality_rejects_outliers(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, 80), "en", "a", 1) for i in range(200)]
    rows += [(1000 + i, " ".join(x + "###$$$" for x in prose(rng, 80).split()), "en", "a", 1) for i in range(20)]
    got = by_id(quality.quality(spark.createDataFrame(rows, SCHEMA)))
    assert not any(got[1000 + i]["kept"] for i in range(20)) and all(got[i]["kept"] for i in range(200))


def test_quality_judges_small_groups(spark):
    """A small source is judged by its language, a small language by the table."""
    rng = random.Random(6)
    texts = [("en", "a")] * 120 + [("en", "b")] * 6 + [("en", None)] * 6 + [("de", "a")] * 6 + [(None, None)] * 6
    rows = [(i, prose(rng, 80), *group, 1) for i, group in enumerate(texts)]
    rows += [(1000 + i, " ".join(x + "###$$$" for x in prose(rng, 80).split()), *group, 1) for i, group in enumerate([("en", "b"), ("en", None), ("de", "a"), (None, None), ("fr", "z")])]
    got = by_id(quality.quality(spark.createDataFrame(rows, SCHEMA)))
    assert len(got) == len(rows) and all(r["distance"] is not None for r in got.values())
    assert not any(got[1000 + i]["kept"] for i in range(5)) and all(got[i]["kept"] for i in range(len(texts)))


def test_robust_distance_matches_numpy(spark):
    """The distances are Mahalanobis distances of the table's own centre and covariance."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4)) @ np.diag([1, 2, 1, 3])
    df = spark.createDataFrame([("en", "a", *map(float, r)) for r in x], "lang string, source string, x1 double, x2 double, x3 double, x4 double")
    e = quality.estimates(df)
    r = e.first()
    cov = np.array([[r[f"c_{a}_{b}"] if (a, b) in quality.PAIRS else r[f"c_{b}_{a}"] for b in quality.X] for a in quality.X])
    centre = np.array([r[f"m_{a}"] for a in quality.X])
    want = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
    got = [y["d"] for y in quality._distances(quality._with(df, e)).collect()]
    assert np.allclose(sorted(got), sorted(want), rtol=1e-6)


LANGS = {"aa": ["der", "und", "schlicht", "zeit"], "bb": ["los", "que", "ciudad", "noche"]}


def test_language_id(spark, nothing):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(LANGS[x]) for _ in range(30)), x, "s", 1) for i in range(80) for x in [("aa", "bb")[i % 2]]]
    rows += [(900, None, "aa", None, 1), (901, "123 !?", "bb", None, 1), (902, "", None, None, 1), (903, "der Und", None, None, 1), (904, "漢字 漢字漢字 " * 40, None, "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASH})
    model = language_id.fit(df)
    got = by_id(language_id.predict(df, model))
    assert all(got[r[0]]["lang_pred"] == r[2] and not got[r[0]]["rejected"] for r in rows[:80])
    assert [got[i]["lang_pred"] for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"] and all(0 <= r["score"] <= 1 for r in got.values())
    assert got[904]["rejected"]
    kept = language_id.keep_known(df, model)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {d for d, r in got.items() if not r["rejected"]}
    assert language_id.predict(nothing, model).count() == 0
    assert language_id.predict(df, language_id.fit(nothing)).where("lang_pred != 'und'").count() == 0


def test_every_language_is_learned(spark):
    rng = random.Random(12)
    rows = []
    for lang in range(210):
        own = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(5)]
        rows += [(8 * lang + i, " ".join(rng.choice(own) for _ in range(30)), f"l{lang:03d}", "a", 1) for i in range(8)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = by_id(language_id.predict(df, language_id.fit(df)))
    assert all(got[r[0]]["lang_pred"] == r[2] for r in rows)


def test_kneser_ney_sums_to_one():
    counts = {x: collections.Counter() for x in LANGS}
    for x, words in LANGS.items():
        for w in words:
            s = f" {w} "
            for i in range(1, len(s)):
                counts[x][s[max(0, i - 4) : i + 1]] += 3
    m = language_id.Models(counts)
    letters = sorted({g[-1] for c in counts.values() for g in c})
    for context in (" ", " d", "zeit", "los", "qqqq"):
        c = [np.full(len(letters) + 1, ord(x), np.uint32) for x in reversed(context)]
        last = np.array([*map(ord, letters), 0x4E2D], np.uint32)
        columns = ([last, *c] + [np.full(len(last), 32, np.uint32)] * 5)[:5]
        p = 2.0 ** -m.score(columns, np.full(len(last), len(context) + 1))
        assert np.allclose(p.sum(axis=0), 1, atol=1e-6)


def test_toxicity(spark, nothing):
    rng = random.Random(9)
    bad = ["idiotic", "scummy", "loserish"]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        rows.append((i, prose(rng, 30) + (" " + " ".join(rng.sample(bad, 2)) if toxic else ""), "en", "a", 1))
        labels.append((i, 1, int(toxic)))
    rows += [(900, None, None, None, 1), (901, "", "en", "a", 1), rows[0]]
    labels += [(5000, 1, 1), (1, None, None), (None, 1, 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASH if c != "score"})
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, lab.where("doc_id % 5 != 0 OR doc_id IS NULL"))
    got = toxicity.toxicity(df, model).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] < 400:
            assert (r["score"] >= 0.7) == (r["doc_id"] % 4 == 0)
        assert 0 <= r["score"] <= 1
    assert toxicity.toxicity(nothing, model).count() == 0
    assert {r["score"] for r in toxicity.toxicity(df, toxicity.fit(df, lab.limit(0))).collect()} == {0.0}


def test_rare_toxic_word_beside_many(spark):
    """A toxic word counts however many stronger terms there are."""
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    bad = ["".join(x) for x in zip(*[[rng.choice(letters) for _ in range(300)] for _ in range(10)])]
    rows = [(i, prose(rng, 30) + " " + " ".join(rng.sample(bad, 20)), "en", "a", 1) for i in range(300)]
    rows += [(300 + i, prose(rng, 30) + " zyzzyvas", "en", "a", 1) for i in range(16)] + [(400 + i, prose(rng, 30), "en", "a", 1) for i in range(600)]
    labels = [(r[0], 1, int(r[0] < 400)) for r in rows]
    model = toxicity.fit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert len(model.vectors.keys) > 600
    assert model.score(prose(rng, 30) + " zyzzyvas")[0] >= 0.7 > model.score(prose(rng, 30))[0]


def test_block_max_neighbours_are_exact(monkeypatch):
    rng = np.random.default_rng(7)
    vectors = [(np.empty(0, np.int64), np.empty(0))]
    for _ in range(700):
        at = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        w = rng.random(len(at)) + 0.1
        vectors.append((at, (w / np.sqrt(w @ w)).astype(np.float32).astype(float)))
    vectors += vectors[:40]  # ties
    cut = np.concatenate(([0], np.cumsum([len(at) for at, _ in vectors])))
    dense = np.zeros((len(vectors), 40))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    for long, block in ((0, 64), (8, 16), (40, 64), (40, 1000)):
        monkeypatch.setattr(toxicity, "LONG", long)
        monkeypatch.setattr(toxicity, "BLOCK", block)
        index = toxicity.BlockMaxIndex(np.concatenate([at for at, _ in vectors]), np.concatenate([w for _, w in vectors]), cut, 40)
        own = np.arange(0, len(vectors), 7)
        for leave in (None, own):
            got = index.nearest([vectors[i] for i in own], 15, leave)
            for i, (near, sims) in zip(own.tolist(), got, strict=True):
                cosine = np.round(dense @ dense[i], 12)
                if leave is not None:
                    cosine[i] = 0
                want = np.lexsort((np.arange(len(cosine)), -cosine))[:15]
                want = want[cosine[want] > 0]
                assert near.tolist() == want.tolist() and np.allclose(sims, cosine[want])


def test_block_max_leaves_out_blocks_by_the_short_lists(monkeypatch):
    """Fifteen neighbours in as many blocks: what the short lists give them leaves out the other blocks."""
    monkeypatch.setattr(toxicity, "LONG", 1)
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    # term 0 is everyone's, term 1 that of the first in each of 15 blocks; the others stand in blocks of 16 alike
    vectors = []
    for i in range(640):
        near = i % 32 == 0 and i < 480
        w = np.array([0.1, 0.4, 1.0] if near else [0.1, 1.0])
        vectors.append((np.array([0, 1, 2 + i // 16] if near else [0, 2 + i // 16]), (w / np.sqrt(w @ w)).astype(np.float32).astype(float)))
    cut = np.concatenate(([0], np.cumsum([len(at) for at, _ in vectors])))
    index = toxicity.BlockMaxIndex(np.concatenate([at for at, _ in vectors]), np.concatenate([w for _, w in vectors]), cut, 42)
    seen, add = [], toxicity.BlockMaxIndex._add
    monkeypatch.setattr(toxicity.BlockMaxIndex, "_add", staticmethod(lambda query, sums, wanted, table: (seen.append(int(wanted.sum())), add(query, sums, wanted, table))))
    ((near, sims),) = index.nearest([(np.array([0, 1]), np.array([0.6, 0.8]))], 15)
    assert near.tolist() == list(range(0, 480, 32)) and np.allclose(sims, (0.06 + 0.32) / np.sqrt(1.17))
    assert sum(seen) == 15


def test_toxicity_matches_brute_force(spark):
    """Terms, weights, neighbours, vote, calibration and score, recomputed in plain Python."""
    rng = random.Random(21)
    bad = ["vexing", "vexingly", "grumly"]
    rows = [(i, prose(rng, rng.randrange(1, 40)) + (f" {rng.choice(bad)}!" if i % 3 == 0 else ""), "en", "a", 1) for i in range(150)] + [(500, None, None, None, 1), (501, "zzz", "en", "a", 1)]
    label = {i: int(i % 3 == 0 or i % 17 == 0) for i in range(100)}
    df = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.fit(df, spark.createDataFrame([(i, 1, t) for i, t in label.items()], "doc_id long, quality int, toxic int"))

    def terms(text):
        words = re.findall(r"\w+", (text or "").lower())
        return collections.Counter(words + ["^" + w[:5] for w in words if len(w) > 5])

    counted = {d: terms(t) for d, t, *_ in rows}
    n1, n0 = sum(label.values()), len(label) - sum(label.values())
    share = n1 / (n1 + n0)
    weight = {}
    for t in {t for d in label for t in counted[d]}:
        a, b = (sum(t in counted[d] for d in label if label[d] == k) for k in (1, 0))
        delta = math.log2((a + 5 * share) / (b + 5 * (1 - share)) * (1 - share) / share)
        weight[t] = (math.log((1 + len(rows)) / (1 + sum(t in c for c in counted.values()))) + 1) * delta**2

    def vector(c):
        v = {t: (1 + math.log(n)) * weight[t] for t, n in c.items() if weight.get(t, 0) > 0}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    vectors = {d: vector(c) for d, c in counted.items()}

    def vote(v, leave=None):
        near = sorted(((sum(x * vectors[d].get(t, 0) for t, x in v.items()), d) for d in label if d != leave), key=lambda x: (-round(x[0], 6), x[1]))[:15]
        near = [(s, d) for s, d in near if s > 1e-9]
        w = [s / (1.02 - min(s, 1)) for s, _ in near]
        return (sum(x * label[d] for x, (_, d) in zip(w, near)) + 0.02 * share) / (sum(w) + 0.02) if near else share, near

    got = {r["doc_id"]: r for r in toxicity.toxicity(df, model).collect()}
    votes = sorted((vote(vectors[d], d)[0], label[d]) for d in label)
    for d in got:
        v, near = vote(vectors[d])
        # calibration: the best non-decreasing fit by the max-min formula
        if not near:
            assert got[d]["score"] == pytest.approx(share) and not got[d]["evidence"]
            continue
        assert [round(sum(x * vectors[e].get(t, 0) for t, x in vectors[d].items()), 4) for e in got[d]["evidence"]] == [round(s, 4) for s, _ in near]
        assert abs(got[d]["score"] - (0.999 * np.interp(v, model.knots, model.values) + 0.001 * v)) < 2e-3
    knots = np.array([x for x, _ in votes])
    for k in range(0, len(votes), 9):
        fit = max(min(sum(y for _, y in votes[i : j + 1]) / (j - i + 1) for j in range(k, len(votes))) for i in range(k + 1))
        assert abs(np.interp(knots[k], model.knots, model.values) - fit) < 0.35
    assert got[500]["score"] == pytest.approx(share) and len(got) == len(rows)


def test_language_id_matches_plain_kneser_ney(spark):
    """Bits per letter and the language, by the textbook recursion over the same training words."""
    rng = random.Random(31)
    own = {"aa": ["der", "und", "Stra\u00dfe", "zeit", "zeitung"], "bb": ["los", "que", "ciudad", "noche"], "cc": ["\u6f22\u5b57", "\u6f22", "\u5b57\u6f22\u5b57"]}
    rows = [(i, ", ".join(rng.choice(own[x]) for _ in range(12)), x, "s", 1) for i in range(60) for x in [("aa", "bb", "cc")[i % 3]]] + [(100, "der que zeit ciu", None, "s", 1), (101, "\u6f22 der", None, "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    used = {r[0] for r in df.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(4)) > 0).select("doc_id").collect()}
    words = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    models, letters = {}, {" "}
    for lang in own:
        order = [collections.Counter() for _ in range(6)]
        for d, t, x, *_ in rows:
            for w in words(t) if x == lang and d in used else ():
                s = f" {w} "
                letters.update(s)
                for k in range(2, 5):
                    if len(s) >= k:
                        order[k][s[:k]] += 1
                for i in range(len(s) - 4):
                    order[5][s[i : i + 5]] += 1
        for k in (4, 3, 2, 1):
            for g in {g[1:] for g in order[k + 1] if k == 1 or g[1] != " "}:
                order[k][g] = len({h[0] for h in order[k + 1] if h[1:] == g})
        models[lang] = order
    table = {}
    for lang, order in models.items():
        for k in range(1, 6):
            spread = collections.Counter(order[k].values())
            discount = spread[1] / (spread[1] + 2 * spread[2]) if spread[1] and spread[2] else 0.5
            by_context = collections.defaultdict(dict)
            for g, n in order[k].items():
                by_context[g[:-1]][g[-1]] = n
            table[lang, k] = discount, by_context

    def p(lang, gram):
        out = 1 / (len(letters) + 1)
        for k in range(1, len(gram) + 1):
            discount, by_context = table[lang, k]
            seen = by_context.get(gram[-k:-1])
            if seen:
                total = sum(seen.values())
                out = (max(seen.get(gram[-1], 0) - discount, 0) + discount * len(seen) * out) / total
        return out

    got = by_id(language_id.predict(df, language_id.fit(df)))
    for d, t, *_ in rows:
        bits = {}
        for lang in own:
            cost = [-math.log2(p(lang, s[max(0, i - 4) : i + 1])) for w in words(t) for s in [f" {w} "] for i in range(1, len(s))]
            bits[lang] = sum(cost) / len(cost)
        best = min(sorted(bits), key=bits.get)
        assert got[d]["lang_pred"] == best and abs(got[d]["bits"] - bits[best]) < 1e-4


def test_robust_estimates_match_exhaustive_search(spark):
    """The best subset of all by determinant: eleven of fourteen rows."""
    import itertools

    rng = np.random.default_rng(5)
    x = np.vstack((rng.normal(size=(11, 4)), rng.normal(size=(3, 4)) + 40))
    df = spark.createDataFrame([("en", "a", *map(float, r)) for r in x], "lang string, source string, x1 double, x2 double, x3 double, x4 double")
    r = quality.estimates(df).first()
    best = min((list(c) for c in itertools.combinations(range(14), 11)), key=lambda c: np.linalg.det(np.cov(x[c].T, bias=True)))
    assert best == list(range(11)) and np.allclose([r[f"m_{a}"] for a in quality.X], x[best].mean(axis=0))
    want = np.cov(x[best].T, bias=True) * quality._consistency() + np.diag([quality.RIDGE[a] for a in quality.X])
    assert all(math.isclose(r[f"c_{a}_{b}"], want[quality.X.index(a), quality.X.index(b)], rel_tol=1e-9, abs_tol=1e-12) for a, b in quality.PAIRS)


def test_near_duplicates_recall_and_hot_buckets(spark):
    """Documents that share half of their shingles crowd the buckets; close pairs among them are all found."""
    rng = random.Random(77)
    vocabulary = [f"w{i}" for i in range(4000)]
    common = [rng.choice(vocabulary) for _ in range(60)]
    texts, pairs = [], 0
    for i in range(1500):
        own = common + [rng.choice(vocabulary) for _ in range(60)]
        texts.append(own)
        if i % 6 == 0:  # a copy with the last words changed
            near = own[: 120 - rng.randrange(1, 25)]
            texts.append(near + [rng.choice(vocabulary) for _ in range(120 - len(near))])
    sets = [frozenset(" ".join(w[i : i + 5]) for i in range(len(w) - 4)) for w in texts]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")).collect()}
    by_gram = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by_gram[g].append(i)
    shared = collections.Counter((a, b) for own in by_gram.values() if len(own) < 50 for k, a in enumerate(own) for b in own[k + 1 :])
    links = [(a, b) for a, b in shared if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    pairs = len(links)
    assert pairs > 100 and sum(got[a] == got[b] for a, b in links) == pairs
    assert sum(c != d for d, c in got.items()) == pairs  # and nothing else is joined


# ---- names, repeats, long texts -------------------------------------------------------------------

INNER = ("rank", "n", "bits", "target", "source_size", "name", "nr", "tie", "id", "key", "block", "before", "cum", "doc", "page", "h", "_sha", "_n", "at", "w", "borders", "section", "score", "lang_pred", "x1", "d", "level", "rows")


@pytest.fixture(scope="module")
def clashing(docs):
    df = docs
    for c in INNER:
        df = df.withColumn(c, F.lit("y"))
    return df.withColumn("size", mixing.n_words())


def test_clashing_columns_stay(clashing, docs, rows):
    """Every operator reads a table whose columns are named like its own inner ones."""
    n = len(rows)
    assert mixing.mix(clashing).count() == n
    assert sorted(mixing.mix(clashing).columns) == sorted([*(c for c in clashing.columns if c not in ("source_size", "target")), "source_size", "target", "n_copies"])
    for of in (near_dedup.near_duplicates, exact_dedup.text_groups, substring_dedup.repeated_passages, bpe.encoding_digests, quality.quality):
        assert of(clashing).count() == n
    assert exact_dedup.drop_copies(clashing).columns == clashing.columns and exact_dedup.drop_copies(clashing).count() == exact_dedup.drop_copies(docs).count()
    assert mixing.mixed_documents(clashing).columns == clashing.columns
    held = clashing.withColumn("held_out", F.lit(False))
    assert lm_score.lm_scores(held, held).count() == n
    model = language_id.fit(clashing)
    assert language_id.predict(clashing, model).count() == n and language_id.keep_known(clashing, model).columns == clashing.columns


def test_ids_may_be_ints(docs, rows):
    df = docs.withColumn("doc_id", F.col("doc_id").cast("int"))
    for of in (near_dedup.near_duplicates, substring_dedup.repeated_passages, bpe.encoding_digests, token_counts.section_token_counts, lambda x: language_id.predict(x, language_id.fit(x))):
        assert {r["doc_id"] for r in of(df).collect()} == {r[0] for r in rows}


def test_mix_of_repeated_rows(docs, rows):
    """Rows that are equal in everything, or in doc_id only: the documents are as many as the mix takes."""
    twice = docs.union(docs).union(docs.withColumn("text", F.concat("text", F.lit(" more words"))))
    d = twice.select("*", mixing.n_words().alias("words")).drop("size").withColumnRenamed("words", "size")
    taken = sum(r["n_copies"] * r["size"] for r in mixing.mix(d).collect())
    assert taken <= 1.5 * d.agg(F.sum("size")).first()[0]
    got = mixing.mixed_documents(twice).select(mixing.n_words().alias("n")).agg(F.sum("n")).first()[0]
    assert abs(got - taken) <= 2 * d.agg(F.max("size")).first()[0]
    plain = docs.select("doc_id", "text", "source")
    again = plain.union(plain)
    d = again.withColumn("size", mixing.n_words())
    assert mixing.mixed_documents(again).count() == d.transform(mixing.mix).agg(F.sum("n_copies")).first()[0]


@pytest.mark.parametrize("text", ["word " * 300_000, " " * 1_000_000, "a" * 1_000_000, "\n" * 300_000 + "end", "é中 " * 100_000], ids=["words", "blanks", "letter", "lines", "unicode"])
def test_long_texts(spark, text):
    """A million characters in one text: every operator gives its row."""
    other = "the quick brown fox jumps over the lazy dog and runs away from all of us"
    df = spark.createDataFrame([(1, text, "en", "a", 1), (2, other, "en", "a", 1), (3, text, "en", "b", 1)], SCHEMA)
    assert {r["component_id"] for r in near_dedup.near_duplicates(df).collect()} == ({1, 2} if text.strip() else {1, 2, 3})
    assert exact_dedup.drop_copies(df).count() == 2
    assert by_id(substring_dedup.repeated_passages(df))[2]["n_removed"] == 0
    held = df.withColumn("held_out", F.lit(False))
    assert all(r["score"] < 0 for r in lm_score.lm_scores(held, held).collect())
    assert quality.quality(df).count() == 3 and mixing.mix(df.withColumn("size", mixing.n_words())).count() == 3
    assert language_id.predict(df, language_id.fit(df)).count() == 3
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(df, toxicity.fit(df, labels)).count() == 3
    import public_tokenizers
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    got = by_id(bpe.encoding_digests(df))
    assert (got[1]["n_tokens"], got[1]["ids_sha256"], got[1]["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    counted = token_counts.section_token_counts(df.where("doc_id = 1")).agg(F.sum("n_tokens"), F.max("doc_tokens")).first()
    assert counted[0] == counted[1] == len(ids)


def test_token_counts_equal_the_encoder(docs):
    """doc_tokens is op2's n_tokens, special tokens and long runs included; every section is recounted by characters."""
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(11)
    pool = ["word", "\n", " ", "<|endoftext|>", "中文", "\U0001f600", "x1", "é", "!!", "   ", "\t\n"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(150)] + [" " * 6000 + "x", "x" + " " * 6000, "x <|endoftext|> y"]
    df = docs.sparkSession.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    n = {r["doc_id"]: r["n_tokens"] for r in bpe.encoding_digests(df).collect()}
    for rule in token_counts.RULES:
        got = collections.defaultdict(dict)
        for r in token_counts.section_token_counts(df, rule=rule).collect():
            got[r["doc_id"]][r["section"]] = r
        for i, text in enumerate(texts):
            assert n[i] == got[i][0]["doc_tokens"]
            want = collections.Counter()
            starts = [r["start"] for _, r in sorted(got[i].items())]
            for a, b in t.encode(text, add_special_tokens=False).offsets:
                inside = [max(k for k, s in enumerate(starts) if s <= c) for c in range(a, max(b, a + 1))]
                want[inside[0] if rule == "start" else inside[-1] if rule == "end" else max(dict.fromkeys(inside), key=inside.count)] += 1
            assert {k: r["n_tokens"] for k, r in got[i].items() if r["n_tokens"]} == dict(want)


def test_field_token_counts(spark):
    df = spark.createDataFrame([(1, "A title", "The body of\nit", None), (2, None, "", "x")], "doc_id int, title string, body string, notes string")
    got = [tuple(r) for r in token_counts.field_token_counts(df, ["title", "body", "notes"]).orderBy("doc_id", "start").collect()]
    assert [r[:4] for r in got] == [(1, "title", 0, 8), (1, "body", 8, 23), (1, "notes", 23, 23), (2, "title", 0, 1), (2, "body", 1, 2), (2, "notes", 2, 3)]
    assert all(sum(r[4] for r in got if r[0] == i) == next(r[6] for r in got if r[0] == i) for i in (1, 2))
    with pytest.raises(ValueError):
        token_counts.field_token_counts(df, [])
