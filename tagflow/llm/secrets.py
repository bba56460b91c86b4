"""Secret scans: base patterns, and a linear-chain conditional random field that adds spans.

Tokens are runs of word characters (with + / -) and single other characters. The field
tags each token begin, inside or outside. Features: shape, length, character mix and
spread of the token, its two neighbours on both sides, and features of the whole text
(density of digits and of assignment and bracket signs). Structure: a plain word (no
digit, under 16 characters) is always outside, a span begins at a token that has a digit
or is long, and goes on only without a gap. Plain words therefore cut the chain, and
Viterbi decoding of the runs between them is the decoding of the whole text.

Weights are trained in numpy by stochastic gradient on the log likelihood, on texts that
the base patterns label: at most `SAMPLE_DOCS` texts of at most `SAMPLE_CHARS` characters,
half of them with a base span and half without (with a digit), each the smallest by hash.

Defined cases: null is the empty text and has no span; positions are code points, end
exclusive; a span of the field that touches a base span is left out; repeated rows get
equal answers; if no sample row exists the field adds nothing; an empty table gives an
empty result. Columns other than doc_id and text are not read by the scan.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tagflow.llm.common import text_key

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
# The same three for Spark: a text that one of them matches has a base span.
HOLDS = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}"""
    r"|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"
)
HINTS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "crf")

TOKEN = re.compile(r"[\w+/-]+|[^\w\s]")
DIGIT = re.compile(r"[0-9]")
LONG = re.compile(r"[\w+/-]{16,}")
SIZE = 1 << 13
OUT, BEGIN, INSIDE = 0, 1, 2
SAMPLE_DOCS = 600
SAMPLE_CHARS = 20_000
EPOCHS = 10
SEED = 5
_NO = -1e9


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the base patterns by start, then kind in the order of KINDS."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _value_spans(text: str) -> list[tuple[int, int]]:
    """What the base patterns call the secret itself, without the name before it."""
    low = text.lower()
    out = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 12] if any(h in low for h in HINTS) else []
    return out + [(a, b) for a, b, kind in base_spans(text) if kind != "assign"]


def _shape(token: str) -> str:
    out = ""
    for c in token:
        k = "0" if "0" <= c <= "9" else "a" if c.islower() else "A" if c.isupper() else c
        if not out.endswith(k):
            out += k
            if len(out) == 8:
                break
    return out


def _spread(token: str) -> int:
    n = len(token)
    return round(-sum(k / n * math.log2(k / n) for k in (token.count(c) for c in set(token))))


def _at(name: str) -> int:
    return zlib.crc32(name.encode()) % SIZE


def runs(text: str):
    """(tokens, [(first, last + 1) of each run of tokens that are no plain words and hold a candidate])."""
    tokens = [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(text)]
    plain = [t[2][0].isalpha() and len(t[2]) < 16 and not DIGIT.search(t[2]) for t in tokens]
    found, i = [], 0
    while i < len(tokens):
        if plain[i]:
            i += 1
            continue
        j, candidate = i, False
        while j < len(tokens) and not plain[j]:
            candidate |= may_begin(tokens[j][2])
            j += 1
        if candidate:
            found.append((i, j))
        i = j
    return tokens, found


def may_begin(token: str) -> bool:
    return len(token) >= 6 and (len(token) >= 16 or DIGIT.search(token) is not None)


def file_features(text: str) -> list[str]:
    n = max(len(text), 1)
    level = lambda k: str(min(4, int(math.log2(1 + 1000 * k / n))))
    return [
        "digits" + level(len(DIGIT.findall(text))),
        "signs" + level(text.count("=") + text.count("{") + text.count(";")),
    ]


def features(tokens, i: int, file: list[str]) -> list[int]:
    token = tokens[i][2]
    near = lambda k: tokens[i + k][2].lower() if 0 <= i + k < len(tokens) else ""
    mix = ("d" if DIGIT.search(token) else "") + ("U" if any("A" <= c <= "Z" for c in token) else "") + (
        "l" if any("a" <= c <= "z" for c in token) else ""
    )
    size, spread = min(6, len(token) // 4), _spread(token)
    mixed = mix in ("dl", "dU", "dUl")
    names = [
        "bias", "shape" + _shape(token), f"size{size}", "mix" + mix, f"mix{mix}{size}", f"spread{spread}{mixed}",
        "p1" + near(-1), "p2" + near(-2), "n1" + near(1), "n2" + near(2), *file, *(f + mix for f in file),
    ]
    return [_at(x) for x in names]


@dataclass
class Field:
    emit: np.ndarray   # SIZE x 3
    move: np.ndarray   # 3 x 3, from row to column


def _allowed(tokens, i: int) -> np.ndarray:
    """0 or _NO for each tag of token i, by the structure."""
    token = tokens[i][2]
    joined = i > 0 and tokens[i - 1][1] == tokens[i][0]
    return np.array([0.0, 0.0 if may_begin(token) else _NO, 0.0 if joined else _NO])


_MOVES = np.array([[0, 0, _NO], [0, 0, 0], [0, 0, 0]], float)  # no inside after outside


def _emissions(field: Field, tokens, run, file):
    feats = [features(tokens, i, file) for i in range(*run)]
    scores = np.array([field.emit[f].sum(0) + _allowed(tokens, i) for f, i in zip(feats, range(*run))])
    return feats, scores


def viterbi(scores: np.ndarray, move: np.ndarray) -> list[int]:
    """Best tags of a run between two tokens that are outside."""
    m = move + _MOVES
    best, back = scores[0] + m[OUT], []
    for row in scores[1:]:
        step = best[:, None] + m
        back.append(step.argmax(0))
        best = step.max(0) + row
    tag = int((best + m[:, OUT]).argmax())
    tags = [tag]
    for b in reversed(back):
        tag = int(b[tag])
        tags.append(tag)
    return tags[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def marginals(scores: np.ndarray, move: np.ndarray):
    """(log partition, tag probabilities, expected moves) by forward and backward sums."""
    m, n = move + _MOVES, len(scores)
    fwd, bwd = np.zeros((n, 3)), np.zeros((n, 3))
    fwd[0] = scores[0] + m[OUT]
    for i in range(1, n):
        fwd[i] = _log_sum(fwd[i - 1][:, None] + m, 0) + scores[i]
    bwd[-1] = m[:, OUT]
    for i in range(n - 2, -1, -1):
        bwd[i] = _log_sum(m + (scores[i + 1] + bwd[i + 1])[None, :], 1)
    z = float(_log_sum(fwd[-1] + bwd[-1], 0))
    tags = np.exp(fwd + bwd - z)
    moves = np.zeros((3, 3))
    moves[OUT] += tags[0]
    moves[:, OUT] += tags[-1]
    for i in range(1, n):
        moves += np.exp(fwd[i - 1][:, None] + m + (scores[i] + bwd[i])[None, :] - z)
    return z, tags, moves


def gold_tags(tokens, run, values) -> list[int]:
    tags = []
    for i in range(*run):
        a, b, token = tokens[i]
        inside = next((v for v in values if v[0] < b and a < v[1]), None)
        if inside is None:
            tags.append(OUT)
        elif tags and tags[-1] != OUT and tokens[i - 1][1] == a and tokens[i - 1][1] > inside[0]:
            tags.append(INSIDE)
        else:
            tags.append(BEGIN if may_begin(token) else OUT)
    return tags


def fit(texts: list[str], epochs: int = EPOCHS, seed: int = SEED, rate: float = 0.1, decay: float = 1e-4) -> Field | None:
    """Maximum likelihood by stochastic gradient over the runs of the texts, labelled by the base patterns."""
    data = []
    for text in texts:
        tokens, found = runs(text)
        if not found:
            continue
        file, values = file_features(text), _value_spans(text)
        for run in found:
            feats = [features(tokens, i, file) for i in range(*run)]
            allowed = np.array([_allowed(tokens, i) for i in range(*run)])
            tags = gold_tags(tokens, run, values)
            if all(allowed[k][t] == 0 for k, t in enumerate(tags)):
                data.append((feats, allowed, tags))
    if not data:
        return None
    field = Field(np.zeros((SIZE, 3)), np.zeros((3, 3)))
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        step = rate / (1 + 0.3 * epoch)
        for k in rng.permutation(len(data)):
            feats, allowed, tags = data[k]
            scores = np.array([field.emit[f].sum(0) for f in feats]) + allowed
            _, probs, moves = marginals(scores, field.move)
            path = [OUT, *tags, OUT]
            for a, b in zip(path, path[1:]):
                field.move[a, b] += step
            field.move -= step * moves + step * decay * field.move
            for f, tag, p in zip(feats, tags, probs):
                change = -p
                change[tag] += 1
                for x in f:
                    field.emit[x] += step * (change - decay * field.emit[x])
    return field


def field_spans(text: str, field: Field) -> list[tuple[int, int]]:
    if not (DIGIT.search(text) or LONG.search(text)):
        return []
    tokens, found = runs(text)
    file, out = None, []
    for run in found:
        file = file or file_features(text)
        _, scores = _emissions(field, tokens, run, file)
        for i, tag in zip(range(*run), viterbi(scores, field.move)):
            if tag == BEGIN:
                out.append([tokens[i][0], tokens[i][1]])
            elif tag == INSIDE:
                out[-1][1] = tokens[i][1]
    return [(a, b) for a, b in out]


def find_spans(text: str | None, field: Field | None) -> list[tuple[int, int, str]]:
    """Base spans and added spans of a text, by start, then kind."""
    if not text:
        return []
    base = base_spans(text)
    if field is None:
        return base
    own = [(a, b, "crf") for a, b in field_spans(text, field) if not any(x < b and a < y for x, y, _ in base)]
    return sorted(base + own, key=lambda s: (s[0], KINDS.index(s[2]))) if own else base


def train(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Field | None:
    """A field from at most `sample` distinct texts: of either label half, those with the smallest hashes.

    So secrets that are rare in the corpus are not rare in the sample. The hashes are ranked first, without the texts, so what reaches the driver does not
    grow with the number of tasks.
    """
    held = F.col("text").rlike(HOLDS)
    keyed = docs.where((F.col("text").rlike("[0-9]") | held) & (F.length("text") <= SAMPLE_CHARS)).select(
        "text", text_key(F.col("text")).alias("k"), held.alias("held")
    )
    ranked = keyed.select("held", "k").distinct()
    first = lambda label: ranked.where(F.col("held") == label).orderBy("k").limit(sample // 2).agg(F.max("k").alias("k"))
    last = [first(label).first()["k"] for label in (True, False)]
    if last == [None, None]:
        return None
    low = [F.lit(k) if k is not None else F.lit(None).cast("long") for k in last]
    wanted = keyed.where(F.when(F.col("held"), F.col("k") <= low[0]).otherwise(F.col("k") <= low[1]))
    rows = wanted.groupBy("k").agg(F.min("text").alias("text")).collect()
    return fit([r["text"] for r in sorted(rows, key=lambda r: r["k"])])


SPANS = "array<struct<start:int,end:int,kind:string>>"


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, tk (text hash), spans by start, then kind; one row per document row."""

    def find(batches):
        for pdf in batches:
            spans = [[{"start": a, "end": b, "kind": k} for a, b, k in find_spans(t, field)] for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"], "tk": pdf["tk"], "spans": spans})

    rows = docs.select(
        F.col("doc_id").cast("string").alias("id"), text_key(F.col("text")).alias("tk"), F.coalesce("text", F.lit("")).alias("text")
    )
    kind = docs.schema["doc_id"].dataType
    return rows.mapInPandas(find, f"id string, tk long, spans {SPANS}").select(F.col("id").cast(kind).alias("doc_id"), "tk", "spans")


def redact(docs: DataFrame, field: Field | None, mark: str = "[SECRET]", into: str = "text") -> DataFrame:
    """The rows with every span (merged where they overlap) replaced in column `into`; other columns as they are."""

    def clean(text: pd.Series) -> pd.Series:
        out = []
        for t in text:
            spans = find_spans(t, field)
            if not spans:
                out.append(t)
                continue
            parts, at = [], 0
            for a, b, _ in spans:
                if a >= at:
                    parts += [t[at:a], mark]
                at = max(at, b)
            out.append("".join([*parts, t[at:]]))
        return pd.Series(out, dtype=object)

    return docs.withColumn(into, F.pandas_udf(clean, "string")("text"))
