"""Secret scan: base patterns, and a linear-chain conditional random field.

The field tags the words of a text as secret begin (B), inside (I) or
outside (O).  A word has shape features (length, shares of digits, capitals,
hexadecimal letters and marks, key words, quotes, assignment marks), and
takes part with the shapes of its two neighbours and features of its file.
Weights are fitted on a bounded sample: words around base matches, labelled
by them, words around random places of the same texts, and the latter with
an invented secret, or something harmless that looks like one, put in.  Decoding is
Viterbi; a word whose lead for O exceeds all that the transitions can add is
O on every best path, so only the stretches between such words are decoded.

The method adds spans that overlap no base span; base spans stay.

Null and empty texts have no spans.  A sample without any word teaches nothing,
and only base spans are found.  Repeated rows give
repeated results; an empty table gives an empty one; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import Words, chunks, plain, prepare, split_words, text_key

#: Base kinds in their order (fixed values), the group that holds the secret, and the least length of a group.
BASE = {
    "assign": (re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    "access": (re.compile(r"(AKIA[A-Z0-9]+)"), 1, 18),
    "hex": (re.compile(r"([0-9a-f]+)"), 1, 16),
}
#: What a text must contain for a match to be possible.
HINTS = {"assign": r"(?i)password|passwd|secret|token|api_?key", "access": "AKIA", "hex": "[0-9a-f]{16}"}
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
CRF = "crf"
KINDS = (*BASE, CRF)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = "\"'`()[]{}<>,;:"

O, B, I = 0, 1, 2
#: Features of a word's shape: one category of each group is set.
GROUPS = {"length": 10, "digits": 6, "capitals": 6, "hex": 5, "marks": 5, "key": 2, "assign": 3, "quote": 3, "address": 2, "mixed": 60}
N_SHAPE = sum(GROUPS.values())
N_FILE = 12


@dataclass(frozen=True)
class Config:
    #: Documents of the training sample (expected number), words on each side of a place, places without a match in a document.
    sample_docs: int = 2000
    context: int = 5
    plain_places: int = 3
    max_places: int = 8
    #: Share of the sample's documents that also give a stretch with an invented secret, of shapes the base patterns don't know.
    made_up: float = 0.3
    #: The same for a harmless string that looks like one (a date, an address, a number).
    harmless: float = 0.5
    #: Added to the score of O: what a word must have beyond even odds to be called a secret.
    caution: float = 1.0
    rounds: int = 80
    rate: float = 0.15
    decay: float = 1e-4


@dataclass
class Model:
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    file: np.ndarray
    steps: np.ndarray

    @property
    def swing(self) -> float:
        """What replacing one tag can change in transition scores at most."""
        return 2.0 * float(self.steps.max() - self.steps.min())


def base_spans(text: str, hints: tuple[bool, ...] = (True, True, True)) -> list[tuple[int, int, int, int, int]]:
    """(kind number, start, end, start and end of the secret) of the base matches of a text."""
    found = []
    for k, ((pattern, group, least), may) in enumerate(zip(BASE.values(), hints)):
        if may:
            # runs of hexadecimal digits never touch, so only long ones need a look
            for m in (LONG_HEX if k == 2 else pattern).finditer(text):
                g = 0 if k == 2 else group
                if m.end(g) - m.start(g) >= least:
                    found.append((k, m.start(), m.end(), m.start(g), m.end(g)))
    return found


def shapes(uniq: pa.Array) -> np.ndarray:
    """Feature numbers of each distinct word: one column a group."""
    count = lambda p: pc.count_substring_regex(uniq, p).to_numpy(zero_copy_only=False)
    has = lambda p: pc.match_substring_regex(uniq, p).to_numpy(zero_copy_only=False).astype(np.int64)
    n = pc.utf8_length(uniq).to_numpy(zero_copy_only=False).astype(np.int64)
    share = lambda x, m: np.where(x == 0, 0, 1 + np.minimum(m - 2, x * (m - 1) // np.maximum(n, 1)))
    digits, capitals, low_hex, marks = count("[0-9]"), count("[A-Z]"), count("[a-f]"), count(r"[^A-Za-z0-9\x80-\x{10FFFF}]")
    length = np.searchsorted([2, 4, 6, 8, 12, 16, 20, 28, 40], n, side="right")
    cols = {
        "length": length,
        "digits": share(digits, 6),
        "capitals": share(capitals, 6),
        "hex": share(low_hex + digits, 5),
        "marks": share(marks, 5),
        "key": has(r"(?i)passw(or)?d|secret|token|api_?key|credential|private|auth"),
        "assign": np.where(has("^[:=]+$"), 2, has("[:=][\"']?$")),
        "quote": has("^[\"'`]") + has("[\"'`][.,;]?$"),
        "address": has(r"@|://|^www[.]"),
        "mixed": length * 6 + share(digits, 6),
    }
    out, base = [], 0
    for name, size in GROUPS.items():
        out.append(base + np.minimum(cols[name], size - 1))
        base += size
    return np.column_stack(out).astype(np.int64)


def file_features(texts: pa.Array, words: Words) -> np.ndarray:
    """Feature numbers of each text: its length, lines, assignment marks and digits, three levels each."""
    size = np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), 1)
    count = lambda p: pc.count_substring_regex(texts, p).to_numpy(zero_copy_only=False)
    level = lambda x, a, b: (x > a).astype(np.int64) + (x > b)
    return np.column_stack([level(np.diff(words.offsets), 50, 500), 3 + level(count("\n") / size, 0.002, 0.02), 6 + level(count("[=:]") / size, 0.001, 0.01), 9 + level(count("[0-9]") / size, 0.002, 0.05)])


def emissions(model: Model, words: Words, shape: np.ndarray, files: np.ndarray) -> np.ndarray:
    """Score of each tag for each word of a batch."""
    own, before, after = (w[shape].sum(axis=1) for w in (model.own, model.before, model.after))
    c, rows = words.codes, words.rows
    e = own[c] + model.file[files].sum(axis=1)[rows]
    inner = rows[1:] == rows[:-1]
    e[1:][inner] += before[c[:-1][inner]]
    e[:-1][inner] += after[c[1:][inner]]
    return e


def viterbi(e: np.ndarray, steps: np.ndarray) -> list[int]:
    """Best tags of a stretch whose neighbours are O on both sides."""
    best, back = steps[O] + e[0], []
    for row in e[1:]:
        paths = best[:, None] + steps
        back.append(paths.argmax(axis=0))
        best = paths.max(axis=0) + row
    tags = [int((best + steps[:, O]).argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    return tags[::-1]


def tagged(model: Model, words: Words, e: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """Word ranges (first, end within the text) of secrets, by row."""
    lead = e[:, O] - np.maximum(e[:, B], e[:, I])
    doubt = np.flatnonzero(lead <= model.swing)
    out: dict[int, list[tuple[int, int]]] = {}
    if not len(doubt):
        return out
    rows = words.rows
    cut = np.flatnonzero((np.diff(doubt) != 1) | (rows[doubt[1:]] != rows[doubt[:-1]])) + 1
    firsts = np.concatenate(([0], cut))
    ends = np.append(cut, len(doubt))
    lone = ends - firsts == 1
    # a lone word is a secret if the way through B or I beats O
    steps = model.steps
    at = doubt[firsts[lone]]
    through = np.stack([steps[O, t] + steps[t, O] + e[at, t] for t in (O, B, I)])
    spans = [(int(x), int(x) + 1) for x in at[through.argmax(axis=0) > 0]]
    for a, z in zip(firsts[~lone].tolist(), ends[~lone].tolist()):
        tags = viterbi(e[doubt[a] : doubt[z - 1] + 1], steps)
        start = None
        for k, t in enumerate([*tags, O]):
            if start is not None and t != I:
                spans.append((int(doubt[a]) + start, int(doubt[a]) + k))
                start = None
            if t == B or (t == I and start is None):
                start = k
    for a, z in sorted(spans):
        row = int(rows[a])
        out.setdefault(row, []).append((a - int(words.offsets[row]), z - int(words.offsets[row])))
    return out


def find(texts: pa.Array, model: Model | None) -> list[list[tuple[int, int, int]]]:
    """Spans (start, kind number, end) of each text in order."""
    hints = np.column_stack([pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False) for p in HINTS.values()])
    words = split_words(texts)
    marked = {}
    if model is not None and len(words.codes):
        marked = tagged(model, words, emissions(model, words, shapes(words.uniq), file_features(texts, words)))
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    for i in {*np.flatnonzero(hints.any(axis=1)).tolist(), *marked}:
        text = texts[i].as_py()
        base = [(s, k, e) for k, s, e, _, _ in base_spans(text, tuple(hints[i]))]
        spans = list(base)
        if i in marked:
            places = [m.span() for m in WORD.finditer(text)]
            for a, z in marked[i]:
                start, end = places[a][0], places[z - 1][1]
                while start < end and text[start] in EDGE:
                    start += 1
                while end > start and (text[end - 1] in EDGE or text[end - 1] == "."):
                    end -= 1
                if start < end and not any(s < end and start < e for s, _, e in base):
                    spans.append((start, len(BASE), end))
        out[i] = sorted(spans)
    return out


def made_up(rng: np.random.Generator) -> list[str]:
    """Words of an invented secret, the last one secret: a key word and a mark before it, or a prefix of its own."""
    alphabets = ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789abcdef")
    text = "".join(rng.choice(list(alphabets[rng.integers(len(alphabets))]), int(rng.integers(18, 60))))
    quote = ("", '"', "'")[rng.integers(3)]
    prefix = ("", "", "ghp_", "sk-", "xoxb-", "key-")[rng.integers(6)]
    name = ("key", "auth", "SECRET_KEY", "api-key", "credential", "private_key", "Bearer", "access_token")[rng.integers(8)]
    lead = ([], [name, "="], [f"{name}:"], [name, ":"], [name])[rng.integers(5)] if prefix else ([name, "="], [f"{name}:"], [name, ":"])[rng.integers(3)]
    return [*lead, f"{quote}{prefix}{text}{quote}"]


def harmless(rng: np.random.Generator) -> list[str]:
    """Words that look a little like a secret and are none, sometimes after a mark."""
    n = lambda a, b: int(rng.integers(a, b))
    letters = lambda a, b: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n(a, b)))
    forms = (
        f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(0, 24):02}:{n(0, 60):02}:{n(0, 60):02}", f"{letters(2, 9)}.{n(1, 99)}@{letters(3, 9)}{n(1, 9)}.{letters(3, 8)}.com", f"{n(1, 256)}.{n(0, 256)}.{n(0, 256)}.{n(1, 256)}",
        f"({n(100, 999)})", f"{n(100, 999)}-{n(1000, 9999)}", f"v{n(0, 20)}.{n(0, 20)}.{n(0, 20)}", f"https://{letters(3, 9)}.example.org/{letters(2, 9)}/{n(1, 9999)}?page={n(1, 9)}", letters(12, 30) + (".", ",", "")[n(0, 3)], letters(1, 2).upper() + letters(12, 24) + ".",
        str(n(1, 10**9)), f"{n(1, 999)},{n(100, 999)}.{n(10, 99)}", f"/{letters(2, 8)}/{letters(2, 8)}/{letters(2, 8)}.{letters(2, 4)}", f"{letters(2, 6)}_{letters(2, 6)}({letters(1, 4)})", letters(3, 8).upper(),
    )
    lead = ([], [], [], ["="], [f"{letters(2, 8)}:"], [letters(2, 8), "="])[n(0, 6)]
    return [*lead, forms[n(0, len(forms))]]


def _examples(texts: pa.Array, config: Config, seed: np.ndarray) -> list[tuple[list, list, list]]:
    """Training stretches: shape rows (one word more on each side, which has no tag), file features and tags."""
    words = split_words(texts)
    files = file_features(texts, words)
    out: list[tuple[list, list, list]] = []
    for i in range(len(texts)):
        text = texts[i].as_py()
        places = [m.span() for m in WORD.finditer(text)]
        if not places:
            continue
        said = [text[a:z] for a, z in places]
        starts = np.array([p[0] for p in places])
        tags = [O] * len(said)
        centres = []
        for _, _, _, s, e in base_spans(text):
            lo, hi = int(np.searchsorted(starts, s, side="right")) - 1, int(np.searchsorted(starts, e, side="left"))
            tags[lo:hi] = [B] + [I] * (hi - lo - 1)
            centres.append(lo)
        rng = np.random.default_rng(int(seed[i]) & 0xFFFFFFFF)
        if len(centres) > config.max_places:  # any of them, not the first
            centres = sorted(np.random.default_rng(int(seed[i]) & 0xFFFFFF).choice(centres, config.max_places, replace=False).tolist())
        centres += rng.integers(0, len(said), config.plain_places).tolist()
        stretch = lambda w, t, c: (w, t, max(0, c - config.context), min(len(w), c + config.context + 1))
        found = [stretch(said, tags, c) for c in centres]
        for share, make, tag in ((config.made_up, made_up, B), (config.harmless, harmless, O)):
            if rng.random() < share:
                c = int(rng.integers(0, len(said)))
                new = make(rng)
                near = slice(max(0, c - 2 * config.context), c)
                w = [*said[near], *new, *said[c : c + 2 * config.context]]
                t = [*tags[near], *[O] * (len(new) - 1), tag, *tags[c : c + 2 * config.context]]
                found.append(stretch(w, t, len(said[near]) + len(new) - 1))
        for w, t, lo, hi in found:
            out.append(([w[k] if 0 <= k < len(w) else None for k in range(lo - 1, hi + 1)], files[i].tolist(), t[lo:hi]))
    known = sorted({x for w, _, _ in out for x in w if x is not None})
    number = {x: r for x, r in zip(known, shapes(pa.array(known, pa.string())).tolist())}
    return [([number[x] if x is not None else [-1] * len(GROUPS) for x in w], f, t) for w, f, t in out]


def train(docs: DataFrame, config: Config = Config(), id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Fit the field on the ``sample_docs`` rows with the smallest hashes of id and text; equal rows count once."""
    prepare(docs.sparkSession)
    seed = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_key(text_col), F.lit("secrets"))
    rows = docs.select(F.col(text_col).alias("text"), seed.alias("seed"))
    last = rows.select("seed").distinct().orderBy("seed").limit(config.sample_docs).agg(F.max("seed")).collect()[0][0]
    if last is None:
        return None
    picked = rows.where(F.col("seed") <= last).dropDuplicates(["seed"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            got = _examples(plain(b.column("text")), config, b.column("seed").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array([sum(x, []) for x, _, _ in got], pa.list_(pa.int16())), pa.array([f for _, f, _ in got], pa.list_(pa.int16())), pa.array([t for _, _, t in got], pa.list_(pa.int8()))],
                names=["shape", "file", "tags"],
            )

    # (max_places + plain_places) stretches a sampled document
    got = picked.mapInArrow(work, "shape array<short>, file array<short>, tags array<byte>").toArrow().to_pydict()
    stretches = sorted(zip(map(tuple, got["shape"]), map(tuple, got["file"]), map(tuple, got["tags"])))
    if not any(B in t for _, _, t in stretches):
        return None
    return fit(stretches, config)


def fit(stretches: list[tuple], config: Config) -> Model:
    """Maximum likelihood by full-batch Adam on forward-backward gradients, all stretches at once."""
    n, width = len(stretches), 2 * config.context + 1
    shape = np.full((n, width + 2, len(GROUPS)), N_SHAPE, np.int64)
    files = np.array([f for _, f, _ in stretches], np.int64)
    tags = np.zeros((n, width), np.int64)
    live = np.zeros((n, width), bool)
    for i, (s, _, t) in enumerate(stretches):
        x = np.array(s, np.int64).reshape(-1, len(GROUPS))
        shape[i, : len(x)] = np.where(x < 0, N_SHAPE, x)
        tags[i, : len(t)] = t
        live[i, : len(t)] = True
    # one indicator row a word: its own shape, those of its neighbours (none: no indicator), and its file
    block = N_SHAPE + 1
    at = [shape[:, 1:-1][live], block + shape[:, :-2][live], 2 * block + shape[:, 2:][live], 3 * block + np.broadcast_to(files[:, None, :], (n, width, files.shape[1]))[live]]
    x = np.zeros((int(live.sum()), 3 * block + N_FILE), np.float32)
    for cols in at:
        x[np.arange(len(x))[:, None], cols] = 1
    x[:, [block - 1, 2 * block - 1, 3 * block - 1]] = 0
    gold = np.eye(3)[tags[live]]
    gold_steps = np.zeros((3, 3))
    pairs = live[:, 1:]
    np.add.at(gold_steps, (tags[:, :-1][pairs], tags[:, 1:][pairs]), 1)
    p = {"words": np.zeros((x.shape[1], 3)), "steps": np.zeros((3, 3))}
    mean, var = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    e = np.zeros((n, width, 3))
    for t in range(1, config.rounds + 1):
        e[live] = x @ p["words"].astype(np.float32)
        unary, step = marginals(e, p["steps"], live)
        grad = {"words": x.T @ (unary[live] - gold).astype(np.float32), "steps": step - gold_steps}
        for k in p:
            g = grad[k] / n + config.decay * p[k]
            mean[k] = 0.9 * mean[k] + 0.1 * g
            var[k] = 0.99 * var[k] + 0.01 * g * g
            p[k] -= config.rate * (mean[k] / (1 - 0.9**t)) / (np.sqrt(var[k] / (1 - 0.99**t)) + 1e-8)
    p["words"][3 * block : 3 * block + 3, O] += config.caution  # each word has one of the first three file features
    own, before, after = (p["words"][k * block : k * block + N_SHAPE] for k in range(3))
    return Model(own, before, after, p["words"][3 * block :], p["steps"])


def marginals(e: np.ndarray, steps: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tag marginals of every word, and expected transition counts, by forward-backward in log space."""
    n, width, _ = e.shape
    fwd, bwd = np.zeros_like(e), np.zeros_like(e)
    fwd[:, 0] = e[:, 0]
    lse = lambda x, axis: (m := x.max(axis=axis)) + np.log(np.exp(x - np.expand_dims(m, axis)).sum(axis=axis))
    for k in range(1, width):
        nxt = lse(fwd[:, k - 1, :, None] + steps, 1) + e[:, k]
        fwd[:, k] = np.where(live[:, k, None], nxt, fwd[:, k - 1])
    for k in range(width - 2, -1, -1):
        prv = lse(steps + (e[:, k + 1] + bwd[:, k + 1])[:, None, :], 2)
        bwd[:, k] = np.where(live[:, k + 1, None], prv, 0)
    total = lse(fwd[:, -1], 1)
    unary = np.exp(fwd + bwd - total[:, None, None])
    step = np.zeros((3, 3))
    for k in range(1, width):
        both = np.exp(fwd[:, k - 1, :, None] + steps + (e[:, k] + bwd[:, k])[:, None, :] - total[:, None, None])
        step += both[live[:, k]].sum(axis=0)
    return unary, step


def scan(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col`` and found: array of (kind, start, end) in code points, end exclusive."""
    return _scanned(docs, model, (id_col,), text_col).select(F.col("__keep_0").alias(id_col), "found")


def _scanned(docs: DataFrame, model: Model | None, keep: tuple[str, ...], text_col: str) -> DataFrame:
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"__keep_{k}" for k in range(len(keep))]
    rows = docs.select(F.col(text_col).alias("__text"), *[F.col(c).alias(n) for c, n in zip(keep, names)])
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "__text"):
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans] for spans in find(plain(b.column("__text")), shared.value)]
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in names), pa.array(found, span)], names=[*names, "found"])

    return rows.mapInArrow(work, ", ".join([*(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names)), "found array<struct<kind:string,start:int,end:int>>"]))


def spans_text(spans) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def redact(docs: DataFrame, model: Model | None, mark: str = "[secret]", text_col: str = "text") -> DataFrame:
    """The rows with their columns as before, each span of a text replaced by ``mark``."""
    found = _scanned(docs, model, tuple(docs.columns), text_col)
    text = f"__keep_{docs.columns.index(text_col)}"
    # spans in order; overlapping ones share one mark
    step = f"""named_struct('at', greatest(a.at, s.end), 'out', if(s.start >= a.at, concat(a.out, substr({text}, a.at + 1, s.start - a.at), '{mark}'), a.out))"""
    cut = F.expr(f"aggregate(found, named_struct('at', 0, 'out', ''), (a, s) -> {step}, a -> concat(a.out, substr({text}, a.at + 1)))")
    found = found.withColumn(text, F.when(F.size("found") > 0, cut).otherwise(F.col(text)))
    return found.select(*[F.col(f"__keep_{k}").alias(c) for k, c in enumerate(docs.columns)])
