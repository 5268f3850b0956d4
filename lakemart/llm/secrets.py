"""Secret scan: fixed patterns, and a battery of randomness tests.

Base spans come from patterns.  Every run of 20 or more key characters that they
leave over, also beside them, is a candidate.  The smallest alphabet that holds its characters is taken as its
encoding.  Three statistics measure randomness: chi-squared for uniform use of
the alphabet, the number of changes between kinds of characters (runs), and the
correlation of neighbours.  Each is read twice:

* as a test of "drawn at random": a candidate that any of them rejects is none;
* as a test of "written text" (uneven letters, long runs, alike neighbours): the
  p-values are combined by Fisher's rule into the candidate's p-value.  In a run of
  one kind of characters nothing can change, so there the other two are combined.

The longer a run, the more the tests can tell, so the false-discovery rate is
held per class of length, by Benjamini and Hochberg's procedure over all
candidates of the corpus; what travels is a histogram of fixed size.

NULL or empty text: no spans.  Repeated rows each count.  Empty table: no rows.
Further columns are left alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakemart.llm.common import batch_of, sha256, ship, slices

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = 20  # characters of a candidate
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST},}}")
KINDS = ("assign", "access", "hex", "random")
RANK = {kind: i for i, kind in enumerate(KINDS)}

# Encodings, smallest alphabet first.
ALPHABETS = [
    (name, letters, {c: i for i, c in enumerate(letters)})
    for name, letters in (
        ("digits", "0123456789"),
        ("hex", "0123456789abcdef"),
        ("HEX", "0123456789ABCDEF"),
        ("lower", "abcdefghijklmnopqrstuvwxyz"),
        ("UPPER", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
        ("lower36", "0123456789abcdefghijklmnopqrstuvwxyz"),
        ("upper36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
        ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
        ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
        ("mixed", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
    )
]
LENGTHS = (24, 32, 40, 56, 88, 152)  # borders of the classes of length
STEPS, MOST = 10, 300  # p-values are kept as steps of 1/10 of a power of ten

# Written text: how often two letters are equal, how often the kind of character
# changes from one to the next, and how alike neighbours are.
SAME, CHANGE, ALIKE = 0.066, 0.2, 0.3


def kind_of(char: str) -> int:
    return 0 if char.islower() else 1 if char.isupper() else 2 if char.isdigit() else 3


def below(z: float) -> float:
    """The normal distribution function."""
    return 0.5 * math.erfc(-z / math.sqrt(2))


def at_least(successes: int, trials: int, chance: float) -> float:
    """P(binomial >= successes)."""
    return min(1.0, sum(math.comb(trials, k) * chance**k * (1 - chance) ** (trials - k) for k in range(successes, trials + 1)))


@lru_cache(maxsize=1 << 17)  # every (changes, pairs) there is up to 400 pairs
def changes_tail(changes: int, pairs: int) -> float:
    if pairs <= 400:
        return at_least(changes, pairs, CHANGE)
    return below((pairs * CHANGE - changes + 0.5) / math.sqrt(pairs * CHANGE * (1 - CHANGE)))


@dataclass(frozen=True)
class Verdict:
    """Inferred encoding, p-value against written text, whether randomness stands."""

    encoding: str
    p: float
    random: bool


def battery(word: str) -> Verdict:
    """The three tests on one candidate."""
    n = len(word)
    used = set(word)
    kinds = [kind_of(c) for c in word]
    name, letters, index = next(a for a in ALPHABETS if used <= a[2].keys())
    k = len(letters)
    share = n / k
    chi = sum((v - share) ** 2 for v in Counter(word).values()) / share + (k - len(used)) * share
    # Under written text chi-squared is noncentral: k - 1 + n (k * same - 1) on average.
    extra = n * (k * max(SAME, 1.7 / k) - 1)
    p_chi = below((chi - (k - 1 + extra)) / math.sqrt(2 * (k - 1 + 2 * extra)))
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    p_runs = changes_tail(changes, n - 1)
    codes = [index[c] for c in word]
    mean = sum(codes) / n
    spread = sum((c - mean) ** 2 for c in codes)
    serial = sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:])) / spread if spread else 1.0
    p_serial = below((math.atanh(max(-0.999, min(0.999, serial))) - math.atanh(ALIKE)) * math.sqrt(n - 3))
    several = len(set(kinds)) > 1
    half = -sum(math.log(max(p, 1e-30)) for p in (p_chi, p_serial, *[p_runs] * several))
    p = math.exp(-half) * (1 + half + half * half / 2 * several)  # Fisher: chi-squared with six degrees, or four
    # Drawn at random: all three within four deviations.
    share_of = Counter(map(kind_of, letters))
    turn = 1 - sum((v / k) ** 2 for v in share_of.values())
    z_chi = (chi - (k - 1)) / math.sqrt(2 * (k - 1))
    z_runs = (changes - (n - 1) * turn) / math.sqrt(max((n - 1) * turn * (1 - turn), 1e-9))
    z_serial = serial * math.sqrt(n)
    return Verdict(name, p, z_chi < 4 and abs(z_runs) < 4 and abs(z_serial) < 4)


def length_class(size: int) -> int:
    return sum(size >= border for border in LENGTHS)


def step_of(p: float) -> int:
    """-10 log10 p, rounded down, so that a p-value never looks smaller."""
    return min(MOST, int(-STEPS * math.log10(max(p, 1e-300))))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns, by start and then kind."""
    spans = []
    if ":" in text or "=" in text:
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], RANK[s[0]]))


def candidates(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, class of length, step) of each candidate: what the base spans leave over of a run.

    Step 0 stands for candidates that are not random or not tellable.
    """
    covered = joined(base)
    at = 0
    for m in CANDIDATE.finditer(text):
        start, last = m.span()
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        here = at
        while start < last:
            inside = here < len(covered) and covered[here][0] < last
            stop, following = covered[here] if inside else (last, last)
            if stop - start >= LEAST:
                verdict = battery(text[start:stop])
                yield start, stop, length_class(stop - start), step_of(verdict.p) if verdict.random else 0
            start = max(start, following)
            here += 1


def joined(spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The places that spans cover, as disjoint (start, end) in order."""
    out: list[tuple[int, int]] = []
    for _, start, end in spans:  # by start
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def histogram(docs: DataFrame, text: str) -> DataFrame:
    """Candidates per class of length and step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter[tuple[int, int]] = Counter()
        for _, texts in slices(batches, "__text"):
            for value in texts:
                counted.update(c[2:] for c in candidates(value, base_spans(value)))
        cells = list(counted)
        yield pa.RecordBatch.from_arrays(
            [pa.array([c[i] for c in cells], pa.int64()) for i in (0, 1)] + [pa.array([counted[c] for c in cells], pa.int64())],
            names=["length_class", "step", "n"],
        )

    counts = docs.select(docs[text].alias("__text")).mapInArrow(run, "length_class long, step long, n long")
    return counts.groupBy("length_class", "step").agg(F.sum("n").alias("n"))


def thresholds(cells: list[tuple[int, int, int]], rate: float) -> dict[int, int]:
    """The least step to report, per class of length (Benjamini and Hochberg)."""
    least: dict[int, int] = {}
    for group in sorted({c[0] for c in cells}):
        own = sorted(((s, n) for g, s, n in cells if g == group), reverse=True)
        tests, found = sum(n for _, n in own), 0
        for step, n in own:
            found += n
            if step > 0 and tests * 10 ** (-step / STEPS) <= rate * found:
                least[group] = step
    return least


def fit(docs: DataFrame, text: str = "text", rate: float = 0.01) -> dict[int, int]:
    """Thresholds for this corpus at a false-discovery rate; at most 7 x 301 cells come back."""
    ship(docs.sparkSession)
    return thresholds([tuple(r) for r in histogram(docs, text).collect()], rate)


def all_spans(text: str, least: dict[int, int]) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and these with the random ones, by start and then kind."""
    base = base_spans(text)
    extra = [("random", s, e) for s, e, group, step in candidates(text, base) if step >= least.get(group, MOST + 1)]
    return base, sorted(base + extra, key=lambda s: (s[1], RANK[s[0]])) if extra else base


def shown(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", rate: float = 0.01) -> DataFrame:
    """The keys with counts of base spans, base_sha256 and all spans of every document."""
    least, names = fit(docs, text, rate), list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "__text"):
            rows = [all_spans(t, least) for t in texts]
            kinds = [Counter(s[0] for s in every) for _, every in rows]
            yield batch_of(
                batch,
                names,
                **{f"n_{k}": pa.array([c[k] for c in kinds], pa.int64()) for k in KINDS},
                base_sha256=pa.array([sha256(shown(base)) for base, _ in rows], pa.string()),
                spans=pa.array([shown(every) for _, every in rows], pa.string()),
            )

    picked = docs.select(*names, docs[text].alias("__text"))
    schema = StructType(
        [*(picked.schema[n] for n in names), *(StructField(f"n_{k}", LongType()) for k in KINDS)]
        + [StructField("base_sha256", StringType()), StructField("spans", StringType())]
    )
    return picked.mapInArrow(run, schema)


def redacted(text: str, least: dict[int, int], mark: str) -> str:
    """The text with every span, joined where they touch, replaced by a mark."""
    out, done = [], 0
    for _, start, end in all_spans(text, least)[1]:
        if start > done or not out:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]]) if out else text


def redact(docs: DataFrame, text: str = "text", rate: float = 0.01, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, with the secrets in the text replaced; NULL texts stay."""
    least, place = fit(docs, text, rate), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text):
            nulls = batch.column(place).is_null().to_pylist()
            values = [None if n else redacted(t, least, mark) for t, n in zip(texts, nulls)]
            yield batch.set_column(place, batch.schema.field(place), pa.array(values, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)
