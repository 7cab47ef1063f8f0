"""BPE encoding and decoding by a prefix-sharing trie of distinct words.

The encoding of a word's prefix is fixed by its last token: it is the encoding
of what stands before that token, then the token.  Distinct words of a batch form
a trie, kept as the sorted list of words: that is its depth-first order, and what a
word shares with the one before it is the path both come down.  Each node gets its
last token from its ancestors' states, so that a prefix shared by many words is
encoded once.  A token t ends a prefix if t is a suffix of it and the merges would
leave t and the last token before it apart; the tokens that are suffixes of a path's
prefixes come from an automaton over the vocabulary.

Reads tokenizer files of the ``tokenizers`` library with a BPE model, byte-level
alphabet and an end-of-word suffix.  Documents are worked on in slices of about a
megabyte; a worker's word cache is bounded (two times ``CACHE_WORDS``): a word
that falls out is encoded again.  Caches end with their task, and their memory goes
back to the system.

Defined cases: null and empty texts encode to no ids and decode to ""; special
tokens' strings in a text become their ids, as in the library; repeated rows
and extra columns pass through; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import itertools
import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import release_memory, small_batches, uncollected

CACHE_WORDS = 200_000
SLICE_BYTES = 1 << 20
_END = "\0"             # stands for the end-of-word suffix; no character of the byte alphabet


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(0x100 + hidden.index(b)) for b in range(256)]


class WordTrie:
    """Distinct words; ``encode`` gives the ids of every word put in since the last call."""

    def __init__(self, model: dict):
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        if missing := [c for c in byte_alphabet() if c not in self.vocab]:
            raise ValueError(f"the vocabulary has no token for {len(missing)} of the 256 bytes")
        self.tokens = ahocorasick.Automaton()
        for token, i in self.vocab.items():
            # The end of a word is one symbol, with the character before it.
            shape = token[:-len(self.end)] + _END if self.end and token.endswith(self.end) else token
            self.tokens.add_word(shape, (i, len(shape)))
        self.tokens.make_automaton()
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}      # token: its merge's rank, left, right
        for n, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, made = self.vocab[left], self.vocab[right], self.vocab[left + right]
            self.rank[a, b] = n
            self.parts.setdefault(made, (n, a, b))
        self.apart: dict[tuple[int, int], bool] = {}
        self.words: set[str] = set()

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` as two tokens when one follows the other.

        Goes back in time: the piece at the boundary that was made last is undone,
        and the pair then at the boundary must not have merged before that.
        """
        key = (left, right)
        if (known := self.apart.get(key)) is not None:
            return known
        rank, parts, before, ok = self.rank, self.parts, 1 << 60, True
        while True:
            merged = rank.get((left, right))
            if merged is not None and merged < before:
                ok = False
                break
            l, r = parts.get(left), parts.get(right)
            if l is None and r is None:
                break
            if r is None or (l is not None and l[0] > r[0]):
                before, left = l[0], l[2]              # at the same rank the left pair goes first
            else:
                before, right = r[0] + 1, r[1]
        self.apart[key] = ok
        return ok

    def add(self, word: str) -> None:
        """Insert a word of the byte alphabet."""
        self.words.add(word)

    def encode(self) -> Iterator[tuple[str, tuple[int, ...]]]:
        """Depth first over the trie; empties it."""
        # A state is (last token, state before it); ``states`` holds those of the current path's prefixes.
        apart, stay, matches, end = self.apart, self.stay_apart, self.tokens.iter, _END if self.end else ""
        states: list = [None]
        before = ""
        for word in sorted(self.words):
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            before = word
            del states[shared + 1:]
            states += [None] * (len(word) + len(end) - shared)
            for last, (token, length) in matches(word + end):
                n = last + 1
                if n <= shared or states[n] is not None:
                    continue
                if n == length:
                    states[n] = (token, None)
                elif (state := states[n - length]) is not None:
                    known = apart.get((state[0], token))
                    if known or known is None and stay(state[0], token):
                        states[n] = (token, state)
            yield word, self._ids(states[len(word) + len(end)])
            if end:
                del states[len(word) + 1:]
        self.words = set()

    @staticmethod
    def _ids(state) -> tuple[int, ...]:
        ids = []
        while state is not None:
            ids.append(state[0])
            state = state[1]
        return tuple(reversed(ids))


@functools.lru_cache(maxsize=1)
def _newer() -> tuple[dict[int, str], dict[int, str]]:
    """Characters newer than Python's Unicode tables, on which its modules and the library differ: their lower case, and
    a stand-in of the class (letter, number or sign) that the library puts them in.  Both are asked of the library."""
    import tokenizers
    kinds = [(kind, stand_in, tokenizers.pre_tokenizers.Split(tokenizers.Regex(f"{kind}+"), "removed", invert=True))
             for kind, stand_in in ((r"\p{L}", "b"), (r"\p{N}", "0"))]
    small, lower, stand_ins = tokenizers.normalizers.Lowercase(), {}, {}
    points = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    for i in range(0, len(points), 2048):       # the library keeps much about each character of a text
        text = "".join(map(chr, points[i:i + 2048]))
        lowered = small.normalize_str(text)
        if len(lowered) == len(text):
            lower |= {ord(c): x for c, x in zip(text, lowered) if x != c}
        for kind, stand_in, split in kinds:
            theirs = set("".join(piece for piece, _ in split.pre_tokenize_str(text)))
            ours = set(regex.findall(kind, text))
            stand_ins |= dict.fromkeys(map(ord, theirs - ours), stand_in)
            stand_ins |= {ord(c): "\u2603" for c in ours - theirs if ord(c) not in stand_ins}
    return lower, stand_ins


class Encoder:
    """Text to ids under one tokenizer description (the parsed JSON file)."""

    def __init__(self, spec: dict):
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"the normalizer must be NFC, white space to a space, lower case; it is {kinds}")
        self.trie = WordTrie(spec["model"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                           + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        # Python also counts these four separators as white space, the library does not.
        self.separators = regex.compile("[\x1c-\x1f]")
        self.space = regex.compile(r"\p{White_Space}+")
        self.bytes = {b: c for b, c in enumerate(byte_alphabet()) if chr(b) != c}
        self.chunks: dict[str, tuple[int, ...]] = {}        # white-space-free runs of a text: their ids
        self.older: dict[str, tuple[int, ...]] = {}
        self.words: dict[str, tuple[int, ...]] = {}

    def _split(self, chunk: str) -> list[str | int]:
        """A run's words in the byte alphabet, and special ids."""
        if chunk.isascii() and chunk.isprintable() and "<|" not in chunk:     # plain: bytes are their own characters
            lower = chunk.lower()
            return [lower] if lower.isalpha() else self.pieces.findall(lower)
        out: list[str | int] = []
        for part in self.split_special.split(chunk) if self.split_special else [chunk]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                lower, stand_ins = _newer()
                plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower().translate(lower)   # each character by itself
                shown = plain.translate(stand_ins)      # of the same length
                out += [plain[m.start():m.end()].encode().decode("latin-1").translate(self.bytes)
                        for m in self.pieces.finditer(shown)]
        return out

    def _learn(self, runs: list[str]) -> None:
        """Encode the runs that are not known yet."""
        if len(self.chunks) > CACHE_WORDS:      # what was not met since the last time goes
            self.older, self.chunks, self.words = self.chunks, {}, {}
        if len(self.trie.apart) > CACHE_WORDS:
            self.trie.apart.clear()
        unseen = set(runs).difference(self.chunks)
        again = unseen.intersection(self.older)
        self.chunks.update((c, self.older[c]) for c in again)
        new = {c: self._split(c) for c in unseen - again}
        for w in {w for parts in new.values() for w in parts if isinstance(w, str)}.difference(self.words):
            self.trie.add(w)
        self.words.update(self.trie.encode())
        for c, parts in new.items():
            ids: list[int] = []
            for w in parts:
                ids += self.words[w] if isinstance(w, str) else (w,)
            self.chunks[c] = tuple(ids)

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and the offsets of each text's.

        Each distinct run of a slice is looked up once; its ids are then laid out wherever it stands.
        """
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string()), "")
        if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():
            runs = [self.space.split(t) if self.separators.search(t) else t.split() for t in texts.to_pylist()]
            lists = pa.array([[c for c in run if c] for run in runs], pa.list_(pa.string()))
        else:
            lists = pc.utf8_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn(distinct)
        ids = [self.chunks[c] if c else () for c in distinct]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(size.sum()))
        first = np.cumsum(size) - size
        at = coded.indices.to_numpy().astype(np.int64)
        here = size[at]
        ends = np.cumsum(here)
        place = np.repeat(first[at] - (ends - here), here) + np.arange(ends[-1] if len(ends) else 0)
        words = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]
        return flat[place], np.r_[0, ends][words].astype(np.int32)


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows holding about a megabyte of text each."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(lengths) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(lengths)]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:]) if b > a)


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in kept), column],
                                      names=[*kept, name])


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema.fields if f.name != name), T.StructField(name, kind)])


def read_spec(path: str) -> dict:
    """The tokenizer description at ``path`` (a file of a few megabytes, sent along with the tasks)."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def encode_bpe(df: DataFrame, tokenizer: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add (or replace) the column ``ids``: array<int> of each text's token ids, no special tokens added."""
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer))     # bounded by the file

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(spec.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for a, b in _slices(column):
                with uncollected():
                    flat, ends = encoder.encode(column.slice(a, b - a))
                yield _with(batch.slice(a, b - a), ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
        del encoder
        release_memory()
    return small_batches(df).mapInArrow(work, _schema(df, ids, T.ArrayType(T.IntegerType())))


def _strings(spec: dict) -> list[str | None]:
    """Each id's string, by id."""
    names = dict((i, t) for t, i in spec["model"]["vocab"].items()) | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [names.get(i) for i in range(max(names) + 1)]


def _decoded(column: pa.Array, strings: pa.Array) -> pa.Array:
    """The texts that a column of id lists stands for."""
    flat, ends = column.flatten(), np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(column), 0))]
    known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(strings)))
    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), strings.take(pc.if_else(known, flat, None)))
    return pc.binary_join(lists, " ") if not lists.flatten().null_count else pa.array(
        [" ".join(t for t in tokens if t is not None) for tokens in lists.to_pylist()], pa.string())


def decode_bpe(df: DataFrame, tokenizer: str, *, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add (or replace) the column ``text``: the decoded ids, special tokens kept.

    The tokenizer file names no decoder, so tokens' strings are joined by a space.
    Null ids decode to ""; ids outside the vocabulary are left out.
    """
    table = df.sparkSession.sparkContext.broadcast(_strings(read_spec(tokenizer)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = pa.array(table.value, pa.string())
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                yield _with(part, text, _decoded(part.column(part.schema.get_field_index(ids)), strings))
    return small_batches(df).mapInArrow(work, _schema(df, text, T.StringType()))


def round_trip_bpe(df: DataFrame, tokenizer: str, *, text: str = "text", ids: str = "ids",
                   decoded: str = "decoded") -> DataFrame:
    """``encode_bpe`` and ``decode_bpe`` in one pass (one Python worker a task), with ``ids`` and ``decoded`` in place of ``text``."""
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer))     # bounded by the file
    kept = [c for c in df.columns if c not in (text, ids, decoded)]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(ids, T.ArrayType(T.IntegerType())),
                           T.StructField(decoded, T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, strings = Encoder(spec.value), pa.array(_strings(spec.value), pa.string())
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for a, b in _slices(column):
                with uncollected():
                    flat, ends = encoder.encode(column.slice(a, b - a))
                coded, part = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept),
                                                  coded, _decoded(coded, strings)], names=[*kept, ids, decoded])
        del encoder, strings
        release_memory()
    return small_batches(df).mapInArrow(work, schema)
