"""Byte-level BPE in linear time by backtracking, and decoding by an offset table.

A pre-token is encoded from left to right. An Aho-Corasick automaton over all
tokens gives the longest token at every position; a token may follow its
predecessor only if plain BPE on the two together would keep the boundary
between them. If it would not, shorter prefixes of the token are tried, and
where none fits the predecessor is taken back; a position that failed once is
closed, so each position is entered at most once. The result is that of
merging the pair of lowest rank again and again.

Pre-tokens repeat, so each Python worker keeps the ids of those it has seen, up
to ``REMEMBERED``; dropping them costs time only.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.textio import parts, utf8

#: Pre-tokens whose ids a worker keeps, and pairs of tokens whose verdict it keeps (about 200 and 100 bytes each).
REMEMBERED = 1 << 19
PAIRS_REMEMBERED = 1 << 18
#: Characters of a text that are split into pre-tokens at once.
PIECE = 1 << 20
# The split pattern of byte-level BPE, and its printable stand-ins for bytes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
PRINTED = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]


def _byte_of() -> dict[str, int]:
    """Byte for each stand-in: printable bytes stand for themselves, the rest for 256 upwards."""
    rest = [b for b in range(256) if b not in set(PRINTED)]
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(rest)}


def _latin_split():
    """``SPLIT`` for texts of Latin-1 characters only, with the classes written out: ``re`` is twice as fast on it."""
    within = lambda p: "".join(re.escape(chr(c)) for c in range(256) if regex.match(p, chr(c)))
    letters, numbers, spaces = within(r"\p{L}"), within(r"\p{N}"), within(r"\p{White_Space}")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+").findall


class Vocabulary:
    """Tables of one byte-level BPE vocabulary file (the JSON text of the tokenizers library)."""

    def __init__(self, text: bytes):
        spec = json.loads(text)
        split = spec["pre_tokenizer"] or {}
        if (spec["model"].get("type") != "BPE" or spec.get("normalizer") or split.get("type") != "ByteLevel"
                or split.get("add_prefix_space") or not split.get("use_regex", True)
                or any(spec["model"].get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))):
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        byte_of = _byte_of()
        raw = lambda token: bytes(byte_of[c] for c in token)
        ids = spec["model"]["vocab"]
        char_of = {b: c for c, b in byte_of.items()}

        # Tokens are numbered by rank: the bytes, then the merges in order. left and right give what a token was merged from.
        self.data = [bytes([b]) for b in range(256)]
        self.left, self.right = list(range(256)), list(range(256))
        self.pairs: dict[tuple[int, int], int] = {}
        number = {d: n for n, d in enumerate(self.data)}
        for pair in spec["model"]["merges"]:
            a, b = (raw(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            if a + b in number:
                raise ValueError("two merges make the same token")
            number[a + b] = n = len(self.data)
            self.pairs[number[a], number[b]] = n
            self.data.append(a + b)
            self.left.append(number[a])
            self.right.append(number[b])
        self.size = [len(d) for d in self.data]
        self.id_of = [ids["".join(char_of[b] for b in d)].to_bytes(4, "little") for d in self.data]

        # Tokens that BPE never makes of their own bytes are no candidates.
        made = [n < 256 or self.keeps(self.left[n], self.right[n], n) for n in range(len(self.data))]
        self.automaton = ahocorasick.Automaton()
        for n, d in enumerate(self.data):
            if made[n]:
                self.automaton.add_word(d.decode("latin-1"), (len(d), n))
        self.automaton.make_automaton()
        self.prefix = [next((number[d[:k]] for k in range(len(d) - 1, 0, -1) if d[:k] in number and made[number[d[:k]]]), -1)
                       for d in self.data]

        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens") or []}
        if any(x.get(k) for x in spec.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only plain added tokens are supported")
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.split_any, self.split_latin = regex.compile(SPLIT).findall, _latin_split()

        # The offset table: the bytes of token i are blob[offset[i]: offset[i + 1]].
        by_id = {i: raw(t) for t, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        pieces = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.offset = np.concatenate(([0], np.cumsum([len(p) for p in pieces]))).astype(np.int64)
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)

        self.fits: dict[int, bool] = {}
        self.seen = _Seen(self)

    def keeps(self, a: int, b: int, below: int) -> bool:
        """Whether BPE on tokens a and b leaves the boundary between them, merges of rank ``below`` and up aside.

        The merges that made a and b are undone from the latest to the
        earliest. At each moment the two tokens at the boundary could have
        been merged with each other; if that merge comes before the one undone
        last, the boundary would not have lasted. Of two equal merges the left
        one comes first, hence the ``+ 1`` on the right side.
        """
        while True:
            if self.pairs.get((a, b), below) < below:
                return False
            undo_left = a > b
            for _ in range(2):
                if undo_left and a >= 256:
                    below, a = a, self.right[a]
                    break
                if not undo_left and b >= 256:
                    below, b = b + 1, self.left[b]
                    break
                undo_left = not undo_left
            else:
                return True

    def word(self, data: bytes) -> list[int]:
        """Token numbers of one pre-token."""
        longest = [0] * len(data)
        for end, (size, n) in self.automaton.iter(data.decode("latin-1")):
            longest[end - size + 1] = n  # ends ascend, so the longest comes last
        size, prefix, fits = self.size, self.prefix, self.fits
        is_open = bytearray(b"\1") * (len(data) + 1)
        tokens: list[int] = []
        at, token = 0, longest[0]
        while True:
            last = tokens[-1] if tokens else -1
            while token >= 0:
                end = at + size[token]
                if is_open[end]:
                    if last < 0:
                        break
                    ok = fits.get(last << 32 | token)
                    if ok is None:
                        if len(fits) >= PAIRS_REMEMBERED:
                            fits.clear()
                        ok = fits[last << 32 | token] = self.keeps(last, token, 1 << 40)
                    if ok:
                        break
                token = prefix[token]
            if token >= 0:
                tokens.append(token)
                at = end
                if at == len(data):
                    return tokens
                token = longest[at]
            else:
                is_open[at] = 0
                token = tokens.pop()
                at -= size[token]

    def encode(self, text: str, match_special: bool = True) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not match_special or not self.special or not any(s in text for s in self.special):
            return b"".join(self._plain(text))
        out = []
        for part in self.special_split.split(text):
            out += [self.special[part].to_bytes(4, "little")] if part in self.special else self._plain(part)
        return b"".join(out)

    def _plain(self, text: str) -> Iterator[bytes]:
        for piece in _pieces(text):
            yield from map(self.seen.__getitem__, self.split(piece))

    def split(self, piece: str) -> list[str]:
        """Pre-tokens of a text."""
        try:
            piece.encode("latin-1")
        except UnicodeEncodeError:
            return self.split_any(piece)
        return self.split_latin(piece)

    def decode(self, ids: np.ndarray, step: int = 1 << 20) -> str:
        """Text of ids; bytes that are not UTF-8 become U+FFFD. Unknown ids count as empty."""
        out = []
        ids = ids[ids < len(self.offset) - 1]
        for i in range(0, len(ids), step):
            part = ids[i: i + step].astype(np.int64)
            first = self.offset[part]
            size = self.offset[part + 1] - first
            stop = np.cumsum(size)
            out.append(self.blob[np.repeat(first - stop + size, size) + np.arange(stop[-1])].tobytes())
        return b"".join(out).decode("utf-8", "replace")


class _Seen(dict):
    """Ids (as bytes) by pre-token, encoded at first sight. When full it starts anew, and
    takes back from the former one what is met again."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        v = self.vocabulary
        ids = self.older.get(word) or b"".join([v.id_of[n] for n in v.word(word.encode())])
        if len(word) <= 64:
            if len(self) >= REMEMBERED // 2:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


#: Between two non-space characters, one plain space begins a pre-token of its own wherever the text before it ends.
_CUT = regex.compile(r"\P{White_Space}(?= \P{White_Space})")


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces that split into the same pre-tokens as the whole."""
    start = 0
    while len(text) - start > PIECE:
        cut = _CUT.search(text, start + PIECE)
        if not cut:
            break
        yield text[start: cut.end()]
        start = cut.end()
    yield text[start:] if start else text


_LOADED: dict[str, Vocabulary] = {}


def load(text: bytes) -> Vocabulary:
    """The tables of a vocabulary, built once for each Python worker."""
    digest = hashlib.sha256(text).hexdigest()
    if digest not in _LOADED:
        _LOADED[digest] = Vocabulary(text)
    return _LOADED[digest]


def _mapped(df: DataFrame, column: str, path: str, outputs: list[tuple[str, T.DataType]], of) -> DataFrame:
    """Columns of ``df`` (those named like an output left out) and ``of(vocabulary, column)``'s arrays."""
    with open(path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())  # bounded: one vocabulary file
    names = {n.lower() for n, _ in outputs}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    source = df.select(F.struct(*kept, F.lit(0).alias("_")).alias("_kept"), F.col(f"`{column}`").alias("_in"))
    schema = T.StructType([source.schema["_kept"], *[T.StructField(n, t) for n, t in outputs]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(shared.value)
        for b in parts(batches):
            yield pa.RecordBatch.from_arrays([b.column("_kept"), *of(vocabulary, b.column("_in"))], ["_kept", *[n for n, _ in outputs]])

    out = source.mapInArrow(run, schema)
    return out.select(*[F.col(f"_kept.`{c}`").alias(c) for c in df.columns if c.lower() not in names], *[n for n, _ in outputs])


def encode(docs: DataFrame, path: str, text: str = "text", match_special: bool = True) -> DataFrame:
    """Columns of ``docs`` and ``ids``: little-endian unsigned 32-bit token ids (binary).

    Null and empty texts have no ids; repeated rows are encoded alike, each by itself; an empty table gives no rows; a column
    named ``ids`` is replaced. A text may be as long as a row may be; a piece of it without a place to split, such as a run of
    letters, is held as a list with an entry per byte. Added tokens in a text become their id, or plain
    text if ``match_special`` is false.
    """
    return _mapped(docs, text, path, [("ids", T.BinaryType())], lambda v, c: [
        pa.array([v.encode(t.decode(), match_special) for t in utf8(c)], pa.binary())])


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Columns of ``encoded`` and ``decoded``, the text of its ids (null: empty)."""
    return _mapped(encoded, ids, path, [("decoded", T.StringType())], lambda v, c: [
        pa.array([v.decode(np.frombuffer(x or b"", "<u4")) for x in c.to_pylist()], pa.string())])


def encode_decode(docs: DataFrame, path: str, text: str = "text", match_special: bool = True) -> DataFrame:
    """``encode`` and ``decode`` in one pass: columns of ``docs``, ``ids`` and ``decoded``."""

    def both(v: Vocabulary, c: pa.Array) -> list[pa.Array]:
        ids = [v.encode(t.decode(), match_special) for t in utf8(c)]
        return [pa.array(ids, pa.binary()), pa.array([v.decode(np.frombuffer(x, "<u4")) for x in ids], pa.string())]

    return _mapped(docs, text, path, [("ids", T.BinaryType()), ("decoded", T.StringType())], both)
