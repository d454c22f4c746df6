"""BPE encoding and decoding in batched numpy merge rounds.

All symbols of many words lie in one flat array.  A round looks up every
neighbouring pair by binary search over the sorted pair keys, finds the
lowest rank of each word, merges all its occurrences from left to right
and drops words that have no pair left.  Texts are cut at ASCII white space
first (no token crosses it), and only the distinct pieces of a batch are
encoded; a bounded per-worker cache keeps pieces seen before.

Nulls and empty texts have no tokens and decode to the empty text; repeated
rows give repeated results; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from civiclake.llm.common import batch_of, chunks, plain, ragged, prepare, split_words

#: Pieces a worker remembers; further ones are encoded again when they recur.
CACHE_PIECES = 250_000
#: White space of SIMPLE as Unicode's property has it (Python's \\s adds U+001C to U+001F).
WHITE = r"\t-\r \x85\xa0"
NO_RANK = np.iinfo(np.int64).max

#: Texts of these characters need no composition, and lower-casing them looks at single characters only.
SIMPLE = re.compile("[\x00-ſ]*")


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: printable
    Latin-1 stands for itself, the others take the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class MergeRounds:
    """Encoder and decoder for a byte-level BPE file with a word-end suffix."""

    def __init__(self, spec: str):
        conf = json.loads(spec)
        model = conf["model"]
        vocab = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        self.size = max([*vocab.values(), *(t["id"] for t in conf["added_tokens"])]) + 1
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in conf["added_tokens"]}
        self.special_split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.tokens = [b""] * self.size
        for text, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = text.encode()
        split = next(p for p in conf["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        simple = [chr(c) for c in range(0x180)]
        letter = "".join(c for c in simple if unicodedata.category(c)[0] == "L")
        number = "".join(c for c in simple if unicodedata.category(c)[0] == "N")
        for written, plainly in ((r"[\p{L}]", f"[{letter}]"), (r"[\p{N}]", f"[{number}]"), (r"\p{L}", letter), (r"\p{N}", number), (r"[^\s", f"[^{WHITE}")):
            split = split.replace(written, plainly)
        self.simple_pieces = re.compile(split)
        #: Other texts are normalised and cut by the file's own rules (its vocabulary left out).
        self.cutter = Tokenizer.from_str(json.dumps(conf | {"added_tokens": [], "model": model | {"vocab": {}, "merges": []}}))
        self.cache: dict[str, bytes] = {}

    def merge(self, data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words given as joined UTF-8 bytes; returns them and their offsets."""
        n = len(lengths)
        sym = self.inner[np.frombuffer(data, np.uint8)]
        ends = np.cumsum(lengths)
        sym[ends - 1] = self.last[np.frombuffer(data, np.uint8)[ends - 1]]
        word = np.repeat(np.arange(n), lengths)
        done_sym, done_word = [], []
        while len(sym):
            rank = np.full(len(sym), NO_RANK)
            joined = np.full(len(sym), -1)
            near = np.flatnonzero(word[1:] == word[:-1])
            key = sym[near] * self.size + sym[near + 1]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            rank[near[hit]] = self.ranks[at[hit]]
            joined[near[hit]] = self.merged[at[hit]]
            start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            count = np.diff(np.append(start, len(word)))
            best = np.repeat(np.minimum.reduceat(rank, start), count)
            open_ = best < NO_RANK
            if not open_.all():
                done_sym.append(sym[~open_])
                done_word.append(word[~open_])
                sym, word, rank, best, joined = (x[open_] for x in (sym, word, rank, best, joined))
                if not len(sym):
                    break
            chosen = rank == best
            # of overlapping choices (a a a) the first, third, ... count
            change = np.flatnonzero(chosen & ~np.concatenate(([False], chosen[:-1])))
            if len(change):
                run = np.zeros(len(chosen), np.int64)
                run[change] = change
                chosen &= (np.arange(len(chosen)) - np.maximum.accumulate(run)) % 2 == 0
            sym = np.where(chosen, joined, sym)
            keep = ~np.concatenate(([False], chosen[:-1]))
            sym, word = sym[keep], word[keep]
        if not done_sym:
            return np.empty(0, np.int64), np.zeros(n + 1, np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.concatenate(([0], np.cumsum(np.bincount(word, minlength=n))))

    def cut(self, text: str) -> list[str]:
        """Pieces of normalised text."""
        if SIMPLE.fullmatch(text) and "İ" not in text:
            return self.simple_pieces.findall(text.lower())
        text = self.cutter.normalizer.normalize_str(text)
        return [text[a:z] for _, (a, z) in self.cutter.pre_tokenizer.pre_tokenize_str(text)]

    def parts(self, chunk: str) -> list[str | int]:
        """Pieces of a run of text, special tokens as their ids."""
        out: list[str | int] = []
        if self.special_split and "<" in chunk:
            spans, at = [], 0
            for m in self.special_split.finditer(chunk):
                spans += [chunk[at : m.start()], self.special[m.group()]]
                at = m.end()
            spans.append(chunk[at:])
        else:
            spans = [chunk]
        for span in spans:
            if isinstance(span, int):
                out.append(span)
            elif span:
                out += self.cut(span)
        return out

    def encode_distinct(self, strings: list[str]) -> list[bytes]:
        """Ids (int32, little-endian) of each of some distinct strings without ASCII white space."""
        known = [self.cache.get(s) for s in strings]
        new = [i for i, k in enumerate(known) if k is None]
        if new:
            parts = [self.parts(strings[i]) for i in new]
            number: dict[str, int] = {}
            for p in parts:
                for x in p:
                    if isinstance(x, str):
                        number.setdefault(x, len(number))
            data = [x.encode() for x in number]
            ids, off = self.merge(b"".join(data), np.fromiter(map(len, data), np.int64, len(data)))
            ids = ids.astype("<i4").tobytes()
            piece = [ids[4 * off[i] : 4 * off[i + 1]] for i in range(len(data))]
            for i, p in zip(new, parts, strict=True):
                known[i] = b"".join(piece[number[x]] if isinstance(x, str) else np.int32(x).tobytes() for x in p)
                if len(self.cache) < CACHE_PIECES:
                    self.cache[strings[i]] = known[i]
        return known

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one int32 array, and the offsets of each text."""
        words = split_words(texts)
        each = self.encode_distinct(words.uniq.to_pylist())
        flat = np.frombuffer(b"".join(each), "<i4")
        off = np.concatenate(([0], np.cumsum(np.fromiter(map(len, each), np.int64, len(each)) // 4)))
        ids, at = ragged(flat, off, words.codes)
        return ids, at[words.offsets]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of ids: the tokens joined by one space (the file names no decoder)."""
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))


_LOADED: dict[int, MergeRounds] = {}


def loaded(spec: str) -> MergeRounds:
    """The encoder of a worker process; built once, so its cache lives on between tasks."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED[key] = MergeRounds(spec)
    return _LOADED[key]


def encode_texts(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and token_ids (array of int) of every text; ``spec`` is the tokenizer file's content."""
    return _mapped(docs, spec, id_col, text_col, "token_ids array<int>", pa.list_(pa.int32()), _id_lists)


def _id_lists(coder: MergeRounds, ids: np.ndarray, off: np.ndarray) -> dict:
    return {"token_ids": pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))}


def decode_ids(encoded: DataFrame, spec: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """``id_col`` and decoded (string) of id arrays (null: empty)."""
    prepare(encoded.sparkSession)
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("token_ids"))
    shared = encoded.sparkSession.sparkContext.broadcast(spec)
    schema = pa.schema([("doc_id", _arrow_type(docs_type(rows, "doc_id"))), ("decoded", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(shared.value)
        for b in batches:
            lists = b.column("token_ids")
            ids, off = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
            yield batch_of(schema, doc_id=b.column("doc_id"), decoded=[coder.decode(ids[a:z]).decode() for a, z in zip(off[:-1], off[1:])])

    return rows.mapInArrow(work, f"doc_id {docs_type(rows, 'doc_id')}, decoded string").withColumnRenamed("doc_id", id_col)


def digests(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: n_tokens, SHA-256 of the ids (little-endian unsigned 32-bit) and of the text decoded from them."""
    return _mapped(docs, spec, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", None, _digests)


def _digests(coder: MergeRounds, ids: np.ndarray, off: np.ndarray) -> dict:
    raw = ids.astype("<u4").tobytes()
    spans = list(zip(off[:-1].tolist(), off[1:].tolist()))
    return {
        "n_tokens": pa.array(np.diff(off), pa.int64()),
        "ids_sha256": pa.array([hashlib.sha256(raw[4 * a : 4 * z]).hexdigest() for a, z in spans], pa.string()),
        "decoded_sha256": pa.array([hashlib.sha256(coder.decode(ids[a:z])).hexdigest() for a, z in spans], pa.string()),
    }


def docs_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _arrow_type(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def _mapped(docs: DataFrame, spec: str, id_col: str, text_col: str, columns: str, kind, make: Callable) -> DataFrame:
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(shared.value)
        for b in chunks(batches, "text"):
            ids, off = coder.encode(plain(b.column("text")))
            out = make(coder, ids, off)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *out.values()], names=["doc_id", *out])

    return rows.mapInArrow(work, f"doc_id {docs_type(rows, 'doc_id')}, {columns}").withColumnRenamed("doc_id", id_col)
