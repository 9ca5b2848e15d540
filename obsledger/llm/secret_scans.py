"""Secret scans: fixed patterns, and strings that a token vocabulary cannot shorten."""

from __future__ import annotations

import base64
import re
from functools import lru_cache
from importlib.util import find_spec
from pathlib import Path

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsledger.llm.bpe import PATTERN
from obsledger.llm.tables import add_columns, texts_of

KINDS = ("assign", "access", "hex", "random")
"""In the order in which spans of one start are listed; the first three are the fixed patterns."""

# The patterns of the known kinds. Letters mean ASCII letters only.
ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Known digests and identifiers: hexadecimal of the usual digest lengths, UUIDs, plain numbers and dates.
KNOWN = re.compile(
    r"""(?xai) [0-9a-f]{32} | [0-9a-f]{40} | [0-9a-f]{56} | [0-9a-f]{64} | [0-9a-f]{96} | [0-9a-f]{128}
    | [0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12} | [0-9/_-]+ """
)
UUID = re.compile(r"(?ai)(?<![a-z0-9])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![a-z0-9])")
# A segment with the separator before it.
SEGMENT = re.compile(r"[+/_-]?[^+/_-]*")
SEPARATORS = "+/_-"
CHARS_PER_TOKEN = 2.2
"""A candidate below this ratio is random: words give three and more, random letters and digits under two."""
STRICT = 1.8
"""The ratio, at most, for what is more often words than not: letters without digits, and several segments within a candidate."""
LEAST_RANDOM, LEAST_REST = 16, 8
"""Characters of a random string, and of one that goes on in a span of a fixed kind."""

Span = tuple[str, int, int]


def default_ranks() -> str:
    """Path of the public rank file, where its package is installed."""
    spec = find_spec("public_tokenizers")
    if spec is None or spec.origin is None:
        raise FileNotFoundError("no vocabulary installed: pass the path of one")
    return str(Path(spec.origin).parent / "byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary, once for each Python worker."""
    lines = Path(path).read_bytes().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def fixed_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, each kind from the left without overlap; too short matches drop out."""
    found: list[Span] = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= LEAST_ASSIGNED:
            found.append(("assign", *m.span()))
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in LONG_HEX.finditer(text)]
    return found


# A run of hexadecimal digits of the least length or more: what HEX finds and keeps.
LONG_HEX = re.compile(f"{HEX.pattern[:-1]}{{{LEAST_HEX},}}")


def is_random(value: str, joined: bool, vocabulary: tiktoken.Encoding, ratio: float) -> bool:
    """Too many tokens for words; ``joined`` values are several segments within a candidate."""
    letters = any(c.isalpha() for c in value)
    if not letters or KNOWN.fullmatch(value):
        return False
    plain = not any(c.isdigit() for c in value)
    if plain or joined:
        ratio = min(ratio, STRICT)
        # One-letter and two-letter parts take many tokens, random or not.
        if 4 * sum(c in SEPARATORS for c in value) > len(value):
            return False
    return len(value) < ratio * len(vocabulary.encode_ordinary(value))


def best_runs(scores: list[float]) -> list[tuple[int, int]]:
    """The maximal runs of positive sum (Ruzzo and Tompa), each as (first, past the last)."""
    runs: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum up to the end
    total = 0.0
    for k, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        first, start = k, before
        while True:
            at = len(runs) - 1
            while at >= 0 and runs[at][2] >= start:
                at -= 1
            if at < 0 or runs[at][3] >= total:
                runs.append((first, k + 1, start, total))
                break
            first, start = runs[at][0], runs[at][2]
            del runs[at:]
    return [(a, b) for a, b, _, _ in runs]


def random_parts(value: str, vocabulary: tiktoken.Encoding, ratio: float) -> list[tuple[int, int]]:
    """What is random in a string of segments: all of it, or single segments and runs of segments."""
    if is_random(value, False, vocabulary, ratio):
        return [(0, len(value))]
    found: list[tuple[int, int]] = []
    at = 0
    for known in [*UUID.finditer(value), None]:
        end = known.start() if known else len(value)
        pieces = [(m.start(), m.end()) for m in SEGMENT.finditer(value, at, end) if m.end() > m.start()]
        at = known.end() if known else end
        scores = []
        for a, b in pieces:
            segment = value[a:b].lstrip(SEPARATORS)
            if b - a >= LEAST_RANDOM and len(segment) >= LEAST_RANDOM and is_random(segment, False, vocabulary, ratio):
                found.append((b - len(segment), b))
            # Nothing is joined over a known form of letters and digits.
            known_form = KNOWN.fullmatch(segment) and not segment.isdigit()
            tokens = len(vocabulary.encode_ordinary(value[a:b]))
            scores.append(-float(len(value)) if known_form else min(ratio, STRICT) * tokens - (b - a))
        for first, end in best_runs(scores):
            a, b = pieces[first][0], pieces[end - 1][1]
            a += value[a] in SEPARATORS
            if end - first > 1 and b - a >= LEAST_RANDOM and is_random(value[a:b], True, vocabulary, ratio):
                found.append((a, b))
    whole: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if whole and a < whole[-1][1]:
            whole[-1] = (whole[-1][0], max(b, whole[-1][1]))
        else:
            whole.append((a, b))
    return whole


def random_spans(text: str, taken: list[Span], vocabulary: tiktoken.Encoding, ratio: float) -> list[Span]:
    """Strings that take too many tokens, apart from known forms and from what is found already."""
    found: list[Span] = []
    spans = sorted((a, b) for _, a, b in taken)
    low = 0
    for m in CANDIDATE.finditer(text):
        if KNOWN.fullmatch(m.group()):
            continue
        while low < len(spans) and spans[low][1] <= m.start():
            low += 1
        at, k = m.start(), low
        while at < m.end():
            # Up to the next span of a fixed kind, then on behind it.
            over = k < len(spans) and spans[k][0] < m.end()
            end = max(at, spans[k][0]) if over else m.end()
            rest = text[at:end]
            if len(rest) >= LEAST_RANDOM:
                found += [("random", at + a, at + b) for a, b in random_parts(rest, vocabulary, ratio)]
            elif rest and (over or at > m.start()):
                found += [("random", a, b) for a, b in glued(rest, at, at > m.start(), over, vocabulary, ratio)]
            at = max(at, spans[k][1]) if over else m.end()
            k += 1
    return found


def glued(rest: str, at: int, left: bool, right: bool, vocabulary, ratio: float) -> list[tuple[int, int]]:
    """Short segments of ``rest``, which stands at ``at``, that a span on the left or right goes on from."""
    cuts = [i for i, c in enumerate(rest) if c in SEPARATORS]
    parts = []
    if left:
        parts.append((0, cuts[0] if cuts else len(rest)))
    if right:
        parts.append((cuts[-1] + 1 if cuts else 0, len(rest)))
    return [
        (at + a, at + b)
        for a, b in sorted(set(parts))
        if b - a >= LEAST_REST
        and any(c.isdigit() for c in rest[a:b])
        and is_random(rest[a:b], True, vocabulary, ratio)
    ]


SPANS = T.StructType(
    [
        T.StructField(
            "secrets",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("kind", T.StringType()),
                        T.StructField("start", T.LongType()),
                        T.StructField("end", T.LongType()),
                    ]
                )
            ),
        )
    ]
)


def scan_secrets(
    docs: DataFrame, path: str | None = None, text_col: str = "text", ratio: float = CHARS_PER_TOKEN
) -> DataFrame:
    """``docs`` with ``secrets``: (kind, start, end) in code points, end exclusive, by start and then kind.

    Kinds assign, access and hex are fixed patterns. Kind random is a run of 16 or more
    letters, digits and ``+/_-`` under ``ratio`` characters for each token of the vocabulary at ``path``; where the whole
    run is not, its segments between ``+/_-``, and adjacent segments together, are. Letters without digits, and adjacent
    segments, must be under ``STRICT``. It is no digest of a usual length, UUID or number, and what spans of the fixed kinds
    leave of a run is scanned as a run: random spans overlap
    none of the fixed kinds. Texts are scanned whole. A null or empty text has no spans; rows
    and further columns pass through, a column ``secrets`` is replaced.
    """
    path = path or default_ranks()
    order = {k: i for i, k in enumerate(KINDS)}
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def make():
        vocabulary = encoding(path)

        def columns(batch: pa.RecordBatch) -> list:
            out = []
            for text in texts_of(batch, text_col):
                spans = fixed_spans(text)
                spans += random_spans(text, spans, vocabulary, ratio)
                spans.sort(key=lambda s: (s[1], order[s[0]], s[2]))
                out.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            return [pa.array(out, kind)]

        return columns

    return add_columns(docs, SPANS, make)


def redact(scanned: DataFrame, text_col: str = "text", mark: str = "<SECRET>") -> DataFrame:
    """Scanned documents with each maximal run of secret characters replaced by ``mark``; null stays null."""
    text = F.col(text_col)

    def step(acc, s):
        new = s["start"] > acc["at"]
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.concat(acc["out"], F.when(new, F.concat(gap, F.lit(mark))).when(s["start"] == 0, mark).otherwise(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.char_length(text)))
    return scanned.withColumn(text_col, F.when(F.size("secrets") > 0, F.aggregate("secrets", start, step, rest)).otherwise(text))
