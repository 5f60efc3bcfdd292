"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is exactly one token that can end the
prefix's encoding. ``WordEncoder`` finds it for each prefix in turn: the
automaton over all vocabulary strings gives the tokens that end there, and a
token is the one if it is compatible with the last token of the prefix before
it. Back-pointers from the end of the word give the ids. No merge is replayed,
and a word costs time in proportion to its length.

Compatibility of two neighbours l, r: BPE keeps the border between them iff no
merge joins across it. While merges run in rank order, the symbol at l's right
end walks up l's right spine (the token, its right part, that one's right part
and so on), and the symbol at r's left end up r's left spine. A merge of x
from the one and y from the other happens iff its rank comes before x is taken
into its parent, and no later than y into its own (of equal ranks, the left
one is merged first).
"""

from __future__ import annotations

import gc
import hashlib
import itertools
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, small_batches

NEVER = 1 << 60
# stands for the end-of-word mark behind a word's last symbol
END = ""
# Unicode White_Space; str.split() also cuts at the four separators below.
WHITE = "\t-\r \x85\xa0  -     　"
SPLIT_ONLY_BY_PYTHON = "\x1c\x1d\x1e\x1f"
CACHE_WORDS = 100_000
CACHE_PAIRS = 250_000

# Letters and digits of Unicode versions after Python's tables
# that the tokenizers library knows, and its lower case of them (first and
# last code point; first, last, distance).
LATER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
LATER_DIGITS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
LATER_LOWER = [
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
]


def byte_alphabet() -> list[str]:
    """The printable character of each byte: printable Latin-1 bytes are
    themselves, the rest follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def unicode_class(kind: str) -> str:
    """Ranges of the characters whose general category starts with ``kind``,
    as they stand inside the brackets of a pattern."""
    codes = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == kind]
    runs = [[c for _, c in run] for _, run in itertools.groupby(enumerate(codes), lambda x: x[1] - x[0])]
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)


class WordEncoder:
    """Ids of one pre-token by the prefix programme."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.suffix = suffix
        self.ids = vocab
        self.rank: dict[int, int] = {}  # by left id << 20 | right id
        self.parts: dict[str, tuple[str, str]] = {}
        for i, (a, b) in enumerate(merges):
            self.rank.setdefault(vocab[a] << 20 | vocab[b], i)
            self.parts.setdefault(a + b, (a, b))
        self.right: dict[str, list[tuple[int, int]]] = {}
        self.left: dict[str, list[tuple[int, int]]] = {}
        self.names = {i: t for t, i in vocab.items()}
        # whether a token fits behind another: for each token one dict, by the
        # other, which the automaton hands out with it; those in use by token
        self.fits: dict[int, dict[int, bool]] = {}
        self.pairs = 0
        self.whole: dict[str, int] = {}  # the texts that one token encodes
        self.automaton = ahocorasick.Automaton()
        made = {a + b for a, b in merges}
        for token in vocab:
            base = len(token.removesuffix(suffix)) == 1
            if base or (token in made and self._whole(token)):
                plain = token.removesuffix(suffix) + (END if token.endswith(suffix) else "")
                self.automaton.add_word(plain, (vocab[token], len(plain), {}))
                self.whole[plain] = vocab[token]
        self.automaton.make_automaton()

    def _spine(self, token: str, side: int) -> list[tuple[int, int]]:
        """The symbols at one end of a token, top first, each with the rank of
        the merge that takes it into the one above."""
        out, up = [], NEVER
        while True:
            out.append((self.ids[token], up))
            if token not in self.parts:
                return out
            a, b = self.parts[token]
            up, token = self.rank[self.ids[a] << 20 | self.ids[b]], (a, b)[side]

    def _right(self, token: str) -> list[tuple[int, int]]:
        if token not in self.right:
            self.right[token] = self._spine(token, 1)
        return self.right[token]

    def _left(self, token: str) -> list[tuple[int, int]]:
        if token not in self.left:
            self.left[token] = self._spine(token, 0)
        return self.left[token]

    def _joins(self, l: str, r: str, until: int) -> bool:
        """Whether a merge of rank below ``until`` crosses the border l | r."""
        ranks = self.rank
        for x, up_x in self._right(l):
            for y, up_y in self._left(r):
                rank = ranks.get(x << 20 | y, NEVER)
                if rank < until and rank < up_x and rank <= up_y:
                    return True
        return False

    def _whole(self, token: str) -> bool:
        """Whether the token's own text encodes to it: its two parts meet
        untouched when their merge comes."""
        a, b = self.parts[token]
        return not self._joins(a, b, self.rank[self.ids[a] << 20 | self.ids[b]])

    def compatible(self, l: int, r: int, fits: dict[int, bool]) -> bool:
        """Whether r fits behind l, noted in ``fits``, the dict of r."""
        if self.pairs >= CACHE_PAIRS:
            self._forget_pairs()
        found = fits[l] = not self._joins(self.names[l], self.names[r], NEVER)
        self.fits[r] = fits
        self.pairs += 1
        return found

    def _forget_pairs(self) -> None:
        for fits in self.fits.values():
            fits.clear()
        self.fits.clear()
        self.pairs = 0

    def forget(self) -> None:
        self._forget_pairs()
        for cache in (self.left, self.right):
            cache.clear()

    def tokens(self, word: str) -> list[int]:
        """Ids of ``word``, a pre-token in the byte alphabet."""
        text = word + END
        if text in self.whole:
            return [self.whole[text]]
        last = [-1] * (len(text) + 1)
        size = [0] * (len(text) + 1)
        for end, (token, length, fits) in self.automaton.iter(text):
            to = end + 1
            if last[to] < 0:
                start = to - length
                if start:
                    before = last[start]
                    if before < 0:
                        continue
                    fit = fits.get(before)
                    if not (self.compatible(before, token, fits) if fit is None else fit):
                        continue
                last[to], size[to] = token, length
        out, at = [], len(text)
        while at:
            if last[at] < 0:
                raise ValueError(f"no encoding of {word!r} in this vocabulary")
            out.append(last[at])
            at -= size[at]
        out.reverse()
        return out


class Cache(dict):
    """What ``make`` gives for a string, kept for short ones, in two halves of
    bounded size: a full one becomes the old one, and what is asked for again
    moves on from there, so frequent strings stay."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def __missing__(self, text: str):
        made = self.old.get(text)
        if made is None:
            made = self.make(text)
        if len(text) < 200:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[text] = made
        return made


class Tokenizer:
    """Text to ids and back, as the vocabulary file says: special strings are
    cut out first; the rest is put into NFC and lower case and split into
    words; each word is encoded in the byte alphabet. Decoding joins the
    tokens' strings by one space, as a file without a decoder asks for."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        # What this reader implements; anything else must not pass silently.
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or spec["decoder"] or not model["end_of_word_suffix"]:
            raise ValueError("this vocabulary file asks for steps that are not implemented")
        self.word = WordEncoder(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        # classes by Python's own Unicode tables, the version that the
        # tokenizers library matches; the regex module's are newer
        letters, digits = ("".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in more) for more in (LATER_LETTERS, LATER_DIGITS))
        self.later_lower = {c: c + by for a, b, by in LATER_LOWER for c in range(a, b + 1)}
        pattern = split["pattern"]["Regex"]
        for name, content in ((r"\s", WHITE), (r"\p{L}", unicode_class("L") + letters), (r"\p{N}", unicode_class("N") + digits)):
            pattern = pattern.replace(name, content)
        self.pieces = re.compile(pattern)
        self.white = re.compile(f"[{WHITE}]+")
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.strings = {i: s for s, i in [*model["vocab"].items(), *self.special.items()]}
        self.shown = {i: str(i) for i in self.strings}
        self.runs = Cache(self._run)
        self.pieces_seen = Cache(self._piece)
        self.rendered = Cache(self._render)

    def _run(self, run: str) -> tuple[int, ...]:
        """Ids of a run without white space; pre-tokens never span white
        space, so a text's ids are its runs' ids in a row."""
        if run.isalpha():  # one word, as nearly all runs are, but for the mark behind them
            return self.pieces_seen[run]
        if run[:-1].isalpha() and run[-1] in ".,":
            return self.pieces_seen[run[:-1]] + self.pieces_seen[run[-1]]
        if not run.isascii():
            run = run.translate(self.later_lower)
        return tuple([i for piece in self.pieces.findall(run) for i in self.pieces_seen[piece]])

    def _piece(self, piece: str) -> tuple[int, ...]:
        mapped = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.alphabet)
        return tuple(self.word.tokens(mapped))

    def _render(self, run: str) -> tuple[int, str, str]:
        """A run's number of tokens, its ids and its decoded text."""
        if run.isalpha():  # one word, kept here alone
            ids = self._piece(run)
        elif run[:-1].isalpha() and run[-1] in ".,":  # a word and the mark behind it
            (n, ids, text), (m, more, mark) = self.rendered[run[:-1]], self.rendered[run[-1]]
            return n + m, f"{ids} {more}", f"{text} {mark}"
        else:
            ids = self._run(run)
        return len(ids), " ".join([self.shown[i] for i in ids]), self.decode(ids)

    def split(self, text: str) -> Iterator[tuple[list[str], int | None]]:
        """A text's runs in their normal form, or the id of a special string."""
        parts = self.special_cut.split(text) if "<|" in text else [text]
        for part in parts:
            if part in self.special:
                yield [], self.special[part]
                continue
            if not part.isascii():
                # lower case goes by single characters: no final sigma
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            part = part.lower()
            odd = any(c in part for c in SPLIT_ONLY_BY_PYTHON)
            yield [r for r in self.white.split(part) if r] if odd else part.split(), None

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for runs, special in self.split(text):
            if special is not None:
                out.append(special)
            for ids in map(self.runs.__getitem__, runs):
                out += ids
        return out

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, and the SHA-256 of the ids (decimal, joined by a
        space) and of the decoded text."""
        n, ids, decoded = 0, [], []
        for runs, special in self.split(text):
            if special is not None:
                n += 1
                ids.append(str(special))
                decoded.append(self.strings[special])
            elif runs:
                counts, shown, texts = zip(*map(self.rendered.__getitem__, runs), strict=True)
                n += sum(counts)
                ids += shown
                decoded += texts
        return n, hashlib.sha256(" ".join(ids).encode()).hexdigest(), hashlib.sha256(" ".join(decoded).encode()).hexdigest()

    def forget(self) -> None:
        """Empty the caches; what the vocabulary file says stays."""
        self.word.forget()
        for cache in (self.runs, self.pieces_seen, self.rendered):
            cache.forget()

    def decode(self, ids) -> str:
        return " ".join([self.strings[i] for i in ids])


_LOADED: dict[str, Tokenizer] = {}


def _tokenizer(content: str) -> Tokenizer:
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _LOADED:
        # the caches are large and live as long as the worker: let the
        # collector look at them seldom
        gc.set_threshold(200_000, 20, 100)
        _LOADED[key] = Tokenizer(content)
    return _LOADED[key]


def _forget() -> None:
    """The caches go with the task, the tokenizer stays in the worker."""
    for t in _LOADED.values():
        t.forget()


def _vocabulary(docs: DataFrame, path: str):
    small_batches(docs.sparkSession)
    with open(path, encoding="utf-8") as f:  # a file of fixed size beside the library, sent to the tasks once
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array<int>) for each row of ``docs`` (doc_id, text).
    A null text counts as empty and has no ids; other columns are not read;
    rows that repeat are encoded each; an empty table stays empty."""
    content = _vocabulary(docs, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(content.value)
        for batch in batches:
            ids = pa.array([t.encode(x or "") for x in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(work, _forget), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text for each row of (doc_id, ids); null ids give ''."""
    content = _vocabulary(encoded, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(content.value)
        for batch in batches:
            texts = pa.array([t.decode(x or ()) for x in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(released(work, _forget), "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: ``encode`` and
    ``decode`` in one pass, digested in the task so that neither ids nor
    decoded texts leave it."""
    content = _vocabulary(docs, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(content.value)
        for batch in batches:
            n, a, b = zip(*[t.digests(x or "") for x in batch.column(1).to_pylist()], strict=True) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        released(work, _forget), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
