"""Language identification by interpolated Kneser-Ney character models, one for each language.

A character's context is up to four characters before it in its word (words are runs of letters,
lower-cased, with a space on either side).  Each order's grams and contexts are sorted arrays of
64-bit hashes with a column for each language.  A text gets the language of the lowest cross-entropy
per character; a text whose cross-entropy is far above what texts of that language have, for its
length, is marked as rejected.

The models are fitted on about SAMPLE training documents of each language, whole, for every language
there is; of a language with long documents, on fewer (about SAMPLE_BYTES, but LEAST documents).  A
quarter of them only calibrates the rejection.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import PART, fold, kept, lean, parts, read, save, small, texts_of
from ._text import mix

ORDER = 5
SAMPLE, SAMPLE_BYTES, LEAST = 800, 8_000_000, 100
REJECT_AT = 8.0  # standard deviations
FLOOR = 0.25  # bits a character that any text may be off
MEMO_BYTES = 16 << 20
_U = np.uint64
_STEP = [_U(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64)) for j in range(ORDER)]


def _key(columns: list[np.ndarray], k: int) -> np.ndarray:
    """Hash of grams of k characters; columns[j] is the character j places before the last."""
    total = np.full(len(columns[0]), k, _U)
    for j in range(k):
        total += columns[j].astype(_U) * _STEP[j]
    return mix(total)


def _count(batches):
    """Grams of at most ORDER characters at each place of each word, by language and part of the sample."""
    sums: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words: Counter = Counter()
            for part in parts(text or ""):
                words.update(_lowered([part])[0].tobytes().decode("utf-32-le", "surrogatepass").split())
            own = sums.setdefault(lang, Counter())
            for word, n in words.items():
                s = f" {word} "
                for i in range(1, len(s)):
                    own[s[max(0, i - ORDER + 1) : i + 1]] += n
    for lang, own in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())], names=["lang", "gram", "n"])


def _orders(top: Counter) -> list[Counter]:
    """Counts of grams of 1 to ORDER characters: raw at the highest order and at word starts, else continuations."""
    raw = Counter()  # every suffix-closed gram at a word's start keeps its count
    orders = [Counter() for _ in range(ORDER + 1)]
    for gram, n in top.items():
        if len(gram) == ORDER or gram[0] == " " and len(gram) > 1:
            orders[len(gram)][gram] += n
            raw[gram] += n
    for k in range(ORDER, 1, -1):
        for gram in orders[k]:
            shorter = gram[1:]
            if len(shorter) == 1 or shorter[0] != " ":
                orders[k - 1][shorter] += 1
    return orders


class Models:
    """Tables of all languages; score() gives bits of each gram in each language."""

    def __init__(self, counts: dict[str, Counter]):
        self.languages = sorted(counts)
        width = max(1, len(self.languages))
        letters = {g[-1] for c in counts.values() for g in c}
        self.base = 1.0 / (len(letters) + 1)
        self.orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        fitted = [_orders(counts[x]) for x in self.languages]
        for k in range(1, ORDER + 1):
            grams = sorted({g for f in fitted for g in f[k]})
            contexts = sorted({g[:-1] for g in grams})
            place = {c: i for i, c in enumerate(contexts)}
            alpha, rest = np.zeros((len(grams), width), np.float32), np.ones((len(contexts), width), np.float32)
            at = {g: i for i, g in enumerate(grams)}
            for col, f in enumerate(fitted):
                own = f[k]
                if not own:
                    continue
                spread = Counter(own.values())
                discount = spread[1] / (spread[1] + 2 * spread[2]) if spread[1] and spread[2] else 0.5
                total, kinds = np.zeros(len(contexts)), np.zeros(len(contexts))
                where = np.array([place[g[:-1]] for g in own])
                n = np.array(list(own.values()), float)
                np.add.at(total, where, n)
                np.add.at(kinds, where, 1)
                alpha[[at[g] for g in own], col] = np.maximum(n - discount, 0) / total[where]
                seen = total > 0
                rest[seen, col] = discount * kinds[seen] / total[seen]
            self.orders.append((*self._sorted(grams, k, alpha), *self._sorted(contexts, k - 1, rest)))

    @staticmethod
    def _sorted(grams: list[str], k: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if k == 0 or not grams:
            return np.zeros(len(grams), _U), values
        points = np.array([[ord(c) for c in g] for g in grams], np.uint32)
        key = _key([points[:, k - 1 - j] for j in range(k)], k)
        order = np.argsort(key)
        return key[order], values[order]

    def score(self, columns: list[np.ndarray], length: np.ndarray) -> np.ndarray:
        """Bits of the last character of each gram; length: characters of the gram, context included."""
        p = np.full((len(length), max(1, len(self.languages))), self.base)
        for k, (gram, alpha, context, rest) in enumerate(self.orders, 1):
            some = np.flatnonzero(length >= k)
            if not len(some) or not len(gram):
                continue
            mine = [c[some] for c in columns]
            key = _key(mine, k)
            at = np.minimum(np.searchsorted(gram, key), len(gram) - 1)
            part = np.where((gram[at] == key)[:, None], alpha[at], 0.0)
            if k == 1:
                back = np.broadcast_to(rest[0], part.shape)
            else:
                key = _key(mine[1:], k - 1)
                at = np.minimum(np.searchsorted(context, key), len(context) - 1)
                back = np.where((context[at] == key)[:, None], rest[at], 1.0)
            p[some] = part + back * p[some]
        return -np.log2(np.maximum(p, 1e-12))


class _Memo:
    """Bits of grams met before, by hash: an open-addressed table that starts anew when it is full."""

    def __init__(self, width: int):
        self.width = width
        self.bits = max(10, (MEMO_BYTES // (8 + 4 * width)).bit_length() - 1)
        self.full = min(300_000, (1 << self.bits) * 3 // 10)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, _U)
        self.values = np.zeros((1 << self.bits, self.width), np.float32)
        self.held = 0

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each key, and the keys' places that are not held."""
        slot = (key >> _U(64 - self.bits)).astype(np.int64)
        left = np.flatnonzero(self.keys[slot] != key)
        missing = []
        while len(left):
            free = self.keys[slot[left]] == 0
            missing.append(left[free])
            left = left[~free]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            left = left[self.keys[slot[left]] != key[left]]
        return slot, np.concatenate(missing) if missing else np.empty(0, np.int64)

    def add(self, key: np.ndarray, values: np.ndarray) -> None:
        """New distinct keys."""
        slot, left = (key >> _U(64 - self.bits)).astype(np.int64), np.arange(len(key))
        while len(left):
            free = self.keys[slot[left]] == 0
            self.keys[slot[left[free]]] = key[left[free]]
            won = self.keys[slot[left]] == key[left]
            self.values[slot[left[won]]] = values[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
        self.held += len(key)


@kept
@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The lower-case letter of each code point; 0 where it is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if unicodedata.category(s)[0] == "L":
            low = s.lower()
            out[c] = ord(low[0]) if unicodedata.category(low[0])[0] == "L" else c
    return out


def _lowered(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, a space after each: letters in lower case, all else spaces; and which are letters."""
    points = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    flow = _letters()[points]
    letter = flow > 0
    flow[~letter] = 32
    return flow, letter


def _places(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Columns of the characters of all words (last first), each gram's length, and each text's first place."""
    ends = np.cumsum([len(t) + 1 for t in texts])  # after each text's separator
    flow, letter = _lowered(texts)
    before = np.concatenate(([False], letter[:-1]))
    spot = np.flatnonzero(letter | before)  # letters, and the space that ends a word
    run = np.arange(len(flow)) - np.maximum.accumulate(np.where(letter | before, -1, np.arange(len(flow))))  # 1 for a word's first letter
    length = np.minimum(run[spot] + 1, ORDER)
    padded = np.concatenate((np.full(ORDER, 32, np.uint32), flow))
    columns = [padded[spot + ORDER - j] for j in range(ORDER)]
    first = np.searchsorted(spot, np.concatenate(([0], ends)))
    return columns, length, first


def _segments(texts: list[str | None], size: int):
    """(text's number, part) of the parts of the texts, in lists of about `size` characters."""
    group, held = [], 0
    for i, text in enumerate(texts):
        for part in parts(text or "", size):
            group.append((i, part))
            held += len(part)
            if held >= size:
                yield group
                group, held = [], 0
    if group:
        yield group


def _predict(shared):
    def bits_of(models, memo, columns, length):
        """Bits of each place in each language, from the memo or the models."""
        key = _key([np.where(length > j, columns[j], 0) for j in range(ORDER)], ORDER) | _U(1)
        if memo.held > memo.full:
            memo.clear()
        slot, missing = memo.find(key)
        if not len(missing):
            return memo.values[slot]
        new, index = np.unique(key[missing], return_index=True)
        pick = missing[index]
        bits = models.score([c[pick] for c in columns], length[pick])
        if memo.held + len(new) <= (1 << memo.bits) * 3 // 4:
            memo.add(new, bits)
            return memo.values[memo.find(key)[0]]
        values = memo.values[slot]
        values[missing] = bits[np.searchsorted(new, key[missing])]
        return values

    def predict(batches):
        models, limits = shared.value
        width = max(1, len(models.languages))
        memo = _Memo(width)
        for batch in batches:
            sums, n = np.zeros((batch.num_rows, width)), np.zeros(batch.num_rows, np.int64)
            for group in _segments(batch.column("text").to_pylist(), max(1024, PART // (2 * -(-width // 8)))):
                columns, length, first = _places([part for _, part in group])
                upto = np.zeros((len(length) + 1, width))
                np.cumsum(bits_of(models, memo, columns, length), axis=0, out=upto[1:])
                owner = np.array([i for i, _ in group])
                np.add.at(sums, owner, np.diff(upto[first], axis=0))
                np.add.at(n, owner, np.diff(first))
            mean = sums / np.maximum(n, 1)[:, None]
            best = np.argmin(mean, axis=1)
            low = mean[np.arange(len(n)), best]
            share = 2.0 ** (-np.minimum(n, 60)[:, None] * (mean - low[:, None]))
            score = 1 / share.sum(axis=1)
            centre, spread = limits[0][best], limits[1][best]
            known = (n > 0) & (len(models.languages) > 0)
            far = known & (low > centre + REJECT_AT * np.sqrt(spread / np.maximum(n, 1) + FLOOR**2))
            names = np.array([*models.languages, "und"], dtype=object)[np.where(known, best, len(models.languages))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names.tolist(), pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(np.where(known, low, np.nan), mask=~known), pa.array(n), pa.array(far | ~known)],
                names=["doc_id", "lang_pred", "score", "bits", "n_letters", "rejected"],
            )

    return predict


_SCHEMA = "doc_id long, lang_pred string, score double, bits double, n_letters long, rejected boolean"


def fit(train: DataFrame, sample: int = SAMPLE):
    """Broadcast models and rejection limits from train(doc_id, text, lang); null languages are left out."""
    spark = train.sparkSession
    known = train.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    wanted = F.greatest(F.lit(float(LEAST)), F.least(F.lit(float(sample)), F.count("*") * F.lit(float(SAMPLE_BYTES)) / F.greatest(F.lit(1), F.sum(F.octet_length("text")))))
    rates = save(known.groupBy("lang").agg((F.least(F.lit(1.0), wanted / F.count("*")) * 1_000_000).cast("long").alias("rate")), "rates")
    draw = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(7)), F.lit(1_000_000))
    drawn = known.join(small(spark, rates), "lang").where(draw < F.col("rate")).select("doc_id", "text", "lang").withColumn("part", F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(11)), F.lit(4)))
    counts: dict[str, Counter] = {}
    for r in drawn.where("part > 0").select("lang", "text").mapInArrow(lean(_count, _letters), "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        counts.setdefault(r["lang"], Counter())[r["gram"]] = r["n"]
    models = Models(counts)
    width = max(1, len(models.languages))
    open_ = (np.full(width, 1e9), np.zeros(width))
    first = spark.sparkContext.broadcast((models, open_))
    # how far texts of a language, not counted above, usually are from its model
    bits = texts_of(drawn.where("part = 0")).mapInArrow(lean(_predict(first), _letters), _SCHEMA).where("n_letters > 0")
    mean = bits.groupBy("lang_pred").agg((F.sum(F.col("bits") * F.col("n_letters")) / F.sum("n_letters")).alias("m"), F.sum("n_letters").alias("n"))
    spread = bits.join(F.broadcast(mean.select("lang_pred", "m")), "lang_pred").groupBy("lang_pred").agg(F.first("m").alias("m"), F.percentile_approx(F.pow(F.col("bits") - F.col("m"), 2) * F.col("n_letters"), 0.8).alias("v"))
    centre, var = open_
    for r in spread.collect():
        centre[models.languages.index(r["lang_pred"])], var[models.languages.index(r["lang_pred"])] = r["m"], r["v"]
    first.destroy()
    return spark.sparkContext.broadcast((models, (centre, var)))


def predict(docs: DataFrame, model) -> DataFrame:
    """(doc_id, lang_pred, score, bits, n_letters, rejected) of every row of docs(doc_id, text, ...).

    Texts that are null, empty or without a letter are `und` with score 0 and rejected; so are all if
    nothing was learned.  Languages of equal entropy: the first by code points.  A long text is worked
    on whole, in parts that end between words (a single word of more than 131,072 letters is cut, and
    loses its context there).  Repeated rows are judged each for itself; other columns are ignored,
    whatever their names; an empty table gives an empty result.
    """
    return texts_of(docs).mapInArrow(lean(_predict(model), _letters), _SCHEMA)


def keep_known(docs: DataFrame, model) -> DataFrame:
    """The rows of docs that are not rejected, with all their columns; one pass, no shuffle."""
    judge = _predict(model)

    def keep(batches):
        whole = []

        def narrow():
            for batch in batches:
                whole.append(batch)
                yield batch.select(["doc_id", "text"])

        for judged in judge(narrow()):  # one for each batch, in order
            yield whole.pop().filter(pc.invert(judged.column("rejected")))

    return docs.mapInArrow(lean(keep, _letters), docs.schema)


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 4) == 2
    out = predict(docs, fit(docs.where(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits", "rejected")
