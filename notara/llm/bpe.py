"""Exact byte-pair encoding by dynamic programming over prefixes, and decoding.

Every prefix of a piece of text has exactly one token that can end its encoding.  An Aho-Corasick
automaton (a suffix automaton of the whole vocabulary) gives the tokens that end at each place, and
a test of two neighbouring tokens tells whether merging could cross the border between them; the
first token that is compatible with the last token of the prefix before it is stored, and following
these back-pointers gives the ids.  Pieces repeat, so their ids are kept in a bounded cache.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._shared import PART, kept, lean, read, release, texts_of

#: The pattern that cuts a text into pieces.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""
_END = regex.compile(r"\P{White_Space}(?=\p{White_Space})")
CACHE = 100_000  # pieces in each of two generations
FITS = 250_000  # answers about pairs of tokens
_NEVER = 1 << 60


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Encoder:
    """Encodes and decodes with the vocabulary, merges and added tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.bytes: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self._rank: dict[int, int] = {}  # of a pair's merge
        # of each token: its merge's rank, and the halves that the merge joins; rank -1 for single bytes
        self._made = [array("i", [-1]) * (max(self.bytes) + 1) for _ in range(3)]
        for n, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self._rank[left << 32 | right] = n
            if self._made[0][whole] < 0:
                for kind, value in zip(self._made, (n, left, right), strict=True):
                    kind[whole] = value
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self._length = array("i", [0]) * (max(self.bytes) + 1)
        for i, b in self.bytes.items():
            self._automaton.add_word(b.decode("latin-1"), i)
            self._length[i] = len(b)
        self._automaton.make_automaton()
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes.update({i: t.encode() for t, i in self.added.items()})
        self._split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self._pieces = regex.compile(PATTERN).findall
        self._edges: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
        self._answers: dict[int, bool] = {}
        self._young: dict[str, str] = {}
        self._old: dict[str, str] = {}

    def _edge(self, token: int, side: int) -> tuple[list[int], list[int]]:
        """Tokens that stand at the token's right (2) or left (1) edge while it is built, and when each is merged on."""
        got = self._edges.get((token, side))
        if got is None:
            chain, ends = [token], [_NEVER]
            while self._made[0][chain[-1]] >= 0:
                ends.append(self._made[0][chain[-1]])
                chain.append(self._made[side][chain[-1]])
            got = self._edges[token, side] = (chain[::-1], ends[::-1])
        return got

    def fits(self, a: int, b: int) -> bool:
        """Whether the bytes of tokens a and b together are encoded as a, b."""
        pair = a << 32 | b
        got = self._answers.get(pair)
        if got is None:
            if len(self._answers) >= FITS:
                self._answers.clear()
            got = self._answers[pair] = self._fits(a, b)
        return got

    def _fits(self, a: int, b: int) -> bool:
        (left, left_ends), (right, right_ends) = self._edge(a, 2), self._edge(b, 1)
        i = j = 0
        while True:
            across, one, other = self._rank.get(left[i] << 32 | right[j], _NEVER), left_ends[i], right_ends[j]
            if across < one and across <= other:
                return False
            if one == _NEVER == other:
                return True
            if one <= other:
                i += 1
            else:
                j += 1

    def _encode_bytes(self, text: str) -> list[int]:
        """Ids of one piece, whose bytes are given as code points; last[i] is the last token of what ends with byte i."""
        last = [-1] * len(text) if len(text) < 10_000 else array("i", [-1]) * len(text)
        length, known, fits = self._length, self._answers.get, self.fits
        for end, token in self._automaton.iter(text):
            if last[end] < 0:
                before = end - length[token]
                if before < 0:
                    last[end] = token
                else:
                    first = last[before]
                    if first >= 0:
                        fit = known(first << 32 | token)
                        if fit if fit is not None else fits(first, token):
                            last[end] = token
        at, out = len(text) - 1, []
        while at >= 0:
            token = last[at]
            out.append(token)
            at -= length[token]
        return out[::-1]

    def _piece(self, piece: str) -> str:
        """The piece's ids, as text.  They have been decoded and give the piece again."""
        got = self._old.get(piece)
        if got is None:
            raw = piece.encode("utf-8", "surrogatepass")
            ids = self._encode_bytes(raw.decode("latin-1"))
            if b"".join([self.bytes[i] for i in ids]) != raw:
                raise ValueError(f"the vocabulary can't write {piece[:50]!r}")
            got = ",".join(map(str, ids))
        if len(piece) < 100:
            if len(self._young) >= CACHE:
                self._old, self._young = self._young, {}
            self._young[piece] = got
        return got

    def runs(self, text: str) -> Iterator[tuple[str, int]]:
        """The text in runs of about PART characters, with the id of those that are an added token (else -1).

        A run ends where a piece always ends: before white space that follows something else.
        """
        for k, run in enumerate(self._split.split(text) if self._split else [text]):
            lo = 0
            while not k % 2 and len(run) - lo > 2 * PART:
                found = _END.search(run, lo + PART)
                if not found:
                    break
                yield run[lo : found.end()], -1
                lo = found.end()
            yield run[lo:], self.added[run] if k % 2 else -1

    def parts(self, text: str) -> Iterator[tuple[str, str]]:
        """(ids joined by commas, decoded text) of each run of the text, in order."""
        for run, added in self.runs(text):
            if added >= 0:
                yield str(added), run
            elif run:
                # a piece's text is what its ids decode to (see _piece), and pieces cover the run
                yield ",".join([self._young.get(piece) or self._piece(piece) for piece in self._pieces(run)]), run

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _ in self.parts(text) for i in ids.split(",")]

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, and SHA-256 of the ids joined by commas and of the decoded text."""
        n, one, two = 0, hashlib.sha256(), hashlib.sha256()
        for ids, decoded in self.parts(text):
            one.update(f",{ids}".encode() if n else ids.encode())
            n += ids.count(",") + 1
            two.update(decoded.encode("utf-8", "replace"))
        return n, one.hexdigest(), two.hexdigest()

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")


@kept
@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    made = Encoder(path)
    release()  # what reading the file took
    return made


def _encode(path: str):
    def encode(batches):
        code = encoder(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                ids = [code.encode(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return encode


def _decode(path: str):
    def decode(batches):
        code = encoder(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([code.decode(x or []) for x in part.column("ids").to_pylist()], pa.string())], names=["doc_id", "text"])

    return decode


def _digest(path: str):
    def digest(batches):
        code = encoder(path)
        for batch in batches:
            ids = batch.column("doc_id")
            for lo in range(0, batch.num_rows, 500):
                n, one, two = zip(*[code.digests(text.as_py() or "") for text in batch.column("text").slice(lo, 500)], strict=True)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, 500), pa.array(n, pa.int64()), pa.array(one), pa.array(two)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return digest


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every row of docs(doc_id, text, ...); null text: no ids."""
    return texts_of(docs).mapInArrow(lean(_encode(path or default_vocabulary()), encoder), "doc_id long, ids array<int>")


def decode_documents(rows: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of every row of rows(doc_id, ids); null ids: empty text."""
    return rows.select("doc_id", "ids").mapInArrow(lean(_decode(path or default_vocabulary()), encoder), "doc_id long, text string")


def encoding_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of docs(doc_id, text, ...).

    Null and empty texts have no token.  An added token's text is that token wherever it stands.
    Very long texts are worked on in runs that end between pieces, so they take time in proportion to
    their length and memory for a run; a single longer piece (a run of one kind of character without
    a break) takes eight bytes a byte more.  There are no ties: an encoding is unique.  Rows that
    repeat are encoded each for itself; other columns are ignored, whatever their names; an empty
    table gives an empty result.
    """
    return texts_of(docs).mapInArrow(lean(_digest(path or default_vocabulary()), encoder), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    return encoding_digests(read(spark, sf_dir, "documents"))
