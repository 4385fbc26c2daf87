"""Personal data by fixed patterns and a semi-Markov conditional random field.

The fixed patterns give the base spans, which always stay. The field adds spans the patterns miss: other ways
to write the same kinds of data. Candidate segments are runs of digit groups with short separators,
and words around an at sign in any of its spellings, at most ``MAX_SPAN`` characters and
``MAX_GROUPS`` groups long. A segment is scored as a whole (digits, grouping, separators, check digit,
surroundings); text outside segments scores 0. Dynamic programming over the candidates of a region then
chooses boundaries and kinds together; training maximises the conditional likelihood with the forward and
backward sums of the same lattice.

Training rows: at most ``FIT_WINDOWS`` pieces of text around digits and at signs, in hash order,
labelled by the fixed patterns; copies of them in which the labelled span is spelled another way teach
the other spellings, and copies in which it is made invalid teach what to leave alone. Every document is decoded over its whole text.

Defined cases: null or empty text has no spans; without training rows the field has weight 0 everywhere and
adds nothing; spans of the field that touch a base span go; equal scores prefer no segment; repeated rows get equal
spans; a column of the input named ``spans`` is replaced. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import first_by_hash, ready, staged, table

KINDS = ["email", "ip", "card", "phone"]
MAX_SPAN = 64
MAX_GROUPS = 8
FIT_WINDOWS = 2000
#: How sure the field must be of a span: its marginal probability.
SURE = 0.8

Span = tuple[str, int, int]

# ------------------------------------------------------------------ fixed patterns

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# The lookbehind and the possessive repeats leave the matches as they are and keep long digit runs linear.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (found := _DOMAIN.match(text, at + 1)):
            end = found.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each kind, in the order of the kinds."""
    spans = list(_emails(text))
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(len(g.lstrip("0")) < 3 or (len(g.lstrip("0")) == 3 and int(g.lstrip("0")) <= 255) for g in m.groups()):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return spans


# ------------------------------------------------------------------ candidates and features

_DIGIT = re.compile(r"[0-9]")
_GROUP = re.compile(r"[0-9]+")
_GAP = re.compile(r"\[\.\]|\(dot\)|[ .()/-]{1,3}")
_SPELLED_AT = re.compile(r"at ?[\])]")
_AT = re.compile(r"@| ?[\[(] ?at ?[\])] ?")
_BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]{1,40} ?$")
_AFTER_AT = re.compile(
    r" ?[A-Za-z0-9-]{1,40}(?:(?:\.| ?[\[(] ?dot ?[\])] ?| \. )[A-Za-z0-9-]{1,24}){1,4}"
)
#: Words before a number that tell what it is.
_CUES = frozenset(
    "call card credit debit fax fon host ip isbn mail mobile number order phone server tel telefon version visa".split()
)
_LAST_WORD = re.compile(r"([^\W\d_]+)\W*$")

Candidate = tuple[int, int, str, tuple[str, ...]]


def _shape(lengths: list[int]) -> str:
    return "-".join(map(str, lengths))


def candidates(text: str) -> list[Candidate]:
    """Candidate segments (start, end, kind, features), at most ``MAX_GROUPS`` starts or ends at any place."""
    found: list[Candidate] = []
    for m in _AT.finditer(text) if "@" in text or _SPELLED_AT.search(text) else ():
        left = _BEFORE_AT.search(text, max(0, m.start() - 41), m.start())
        right = _AFTER_AT.match(text, m.end())
        if left and right and right.end() - left.start() <= MAX_SPAN:
            inner = text[left.start() : right.end()]
            features = (
                f"at={m.group().strip()[:1]}",
                f"dots={'dot' if 'dot' in right.group() else 'plain'}",
                f"spaces={inner.count(' ')}",
                f"top={len(right.group().split('.')[-1].strip()) in (2, 3, 4)}",
            )
            found.append((left.start(), right.end(), "email", features))
    groups = [m.span() for m in _GROUP.finditer(text)] if _DIGIT.search(text) else []
    for i, (a, _) in enumerate(groups):
        gaps: list[str] = []
        digits = 0
        for j in range(i, min(i + MAX_GROUPS, len(groups))):
            if j > i:
                gap = text[groups[j - 1][1] : groups[j][0]]
                if len(gap) > 5 or not _GAP.fullmatch(gap):
                    break
                gaps.append(gap)
            digits += groups[j][1] - groups[j][0]
            end = groups[j][1]
            if end - a > MAX_SPAN or digits > 19:
                break
            if digits < 4:
                continue
            start = a
            if start and text[start - 1] == "(":
                start -= 1
            if start and text[start - 1] == "+":
                start -= 1
            found.extend(_number(text, start, end, [groups[k][1] - groups[k][0] for k in range(i, j + 1)], gaps))
    return found


def _number(text: str, start: int, end: int, lengths: list[int], gaps: list[str]) -> Iterator[Candidate]:
    inner = text[start:end]
    digits = "".join(c for c in inner if "0" <= c <= "9")
    n = len(digits)
    before, after = text[start - 1 : start], text[end : end + 1]
    joined = (before.isalnum() or before in "._#=\"'/-+") and bool(before), (after.isalnum() or after in "_#=\"'/-") and bool(after)
    more = bool(after in ".,-" and text[end + 1 : end + 2].isdigit()) if after else False
    more_before = bool(before and before in ".,-" and text[max(0, start - 2) : start - 1].isdigit())
    word = _LAST_WORD.search(text, max(0, start - 16), start)
    cue = word.group(1).lower() if word else ""
    kinds_of_gap = "".join(sorted({"d" if "." in g or "dot" in g else "s" if g == " " else "m" if g == "-" else "p" for g in gaps}))
    common = (
        f"lead={inner[0] if inner[0] in '+(' else 'digit'}",
        f"gaps={kinds_of_gap}",
        f"joined={joined[0]}",
        f"joins={joined[1]}",
        f"inside={more or more_before}",
        f"word={cue if cue in _CUES else 'other'}",
    )
    if len(lengths) == 4 and max(lengths) <= 3 and all("." in g or "dot" in g for g in gaps):
        octets = all(int(x) <= 255 for x in re.findall(r"[0-9]+", inner))
        yield start, end, "ip", (*common, f"octets={octets}", f"same={len(set(gaps)) == 1}")
    if 12 <= n <= 19:
        yield start, end, "card", (*common, f"luhn={luhn(digits)}", f"n={n}", f"shape={_shape(lengths)}", f"valid={luhn(digits) and n >= 13}")
    if 7 <= n <= 15:
        yield start, end, "phone", (*common, f"n={n}", f"shape={_shape(lengths)}", f"groups={min(len(lengths), 6)}")


def regions(found: list[Candidate]) -> Iterator[list[Candidate]]:
    """Candidates in clusters that share no character."""
    cluster: list[Candidate] = []
    reach = -1
    for candidate in sorted(found, key=lambda c: (c[0], c[1], c[2])):
        if cluster and candidate[0] >= reach:
            yield cluster
            cluster = []
        reach = max(reach, candidate[1]) if cluster else candidate[1]
        cluster.append(candidate)
    if cluster:
        yield cluster


# ------------------------------------------------------------------ the field


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


class SemiMarkovField:
    """Weights of whole-segment features; a segment's score is their sum, text outside scores 0."""

    def __init__(self, weights: dict[str, float] | None = None) -> None:
        self.weights = weights or {}

    def score(self, candidate: Candidate) -> float:
        _, _, kind, features = candidate
        get = self.weights.get
        return get(kind, 0.0) + sum(get(f"{kind} {f}", 0.0) for f in features)

    @staticmethod
    def _lattice(cluster: list[Candidate]) -> tuple[list[int], dict[int, int]]:
        places = sorted({p for c in cluster for p in c[:2]})
        return places, {p: i for i, p in enumerate(places)}

    def marginals(self, cluster: list[Candidate]) -> tuple[list[float], float]:
        """Probability of every candidate segment, and the log of the sum over all segmentations."""
        places, at = self._lattice(cluster)
        scores = [self.score(c) for c in cluster]
        ending: list[list[int]] = [[] for _ in places]
        for k, c in enumerate(cluster):
            ending[at[c[1]]].append(k)
        alpha = [0.0] * len(places)
        for i in range(1, len(places)):
            value = alpha[i - 1]
            for k in ending[i]:
                value = _log_add(value, alpha[at[cluster[k][0]]] + scores[k])
            alpha[i] = value
        beta = [0.0] * len(places)
        starting: list[list[int]] = [[] for _ in places]
        for k, c in enumerate(cluster):
            starting[at[c[0]]].append(k)
        for i in range(len(places) - 2, -1, -1):
            value = beta[i + 1]
            for k in starting[i]:
                value = _log_add(value, beta[at[cluster[k][1]]] + scores[k])
            beta[i] = value
        total = alpha[-1]
        return [math.exp(alpha[at[c[0]]] + s + beta[at[c[1]]] - total) for c, s in zip(cluster, scores, strict=True)], total

    def best(self, cluster: list[Candidate]) -> list[Candidate]:
        """The highest-scoring set of segments that don't overlap."""
        places, at = self._lattice(cluster)
        ending: list[list[int]] = [[] for _ in places]
        for k, c in enumerate(cluster):
            ending[at[c[1]]].append(k)
        value, chosen = [0.0] * len(places), [-1] * len(places)
        for i in range(1, len(places)):
            value[i] = value[i - 1]
            for k in ending[i]:
                score = value[at[cluster[k][0]]] + self.score(cluster[k])
                if score > value[i]:
                    value[i], chosen[i] = score, k
        out, i = [], len(places) - 1
        while i > 0:
            if chosen[i] < 0:
                i -= 1
            else:
                out.append(cluster[chosen[i]])
                i = at[cluster[chosen[i]][0]]
        return out[::-1]

    def decode(self, text: str) -> list[Span]:
        """Spans of the best segmentation whose probability is high enough."""
        out = []
        for cluster in regions(candidates(text)):
            chosen = self.best(cluster)
            if chosen:
                sure, _ = self.marginals(cluster)
                chance = dict(zip(((c[0], c[1], c[2]) for c in cluster), sure, strict=True))
                out += [(c[2], c[0], c[1]) for c in chosen if chance[c[0], c[1], c[2]] >= SURE]
        return out

    def fit(self, rows: list[tuple[str, list[Span]]], passes: int = 25, rate: float = 0.5, decay: float = 1e-3) -> SemiMarkovField:
        """Maximise the conditional likelihood of the labelled spans (adaptive gradient steps, L2)."""
        lattices = []
        for text, spans in rows:
            gold = {(a, b, kind) for kind, a, b in spans}
            for cluster in regions(candidates(text)):
                lattices.append((cluster, [float((c[0], c[1], c[2]) in gold) for c in cluster]))
        squares: dict[str, float] = {}
        for _ in range(passes):
            for cluster, gold in lattices:
                chance, _ = self.marginals(cluster)
                gradient: dict[str, float] = {}
                for candidate, target, p in zip(cluster, gold, chance, strict=True):
                    if abs(target - p) > 1e-6:
                        kind = candidate[2]
                        for name in (kind, *(f"{kind} {f}" for f in candidate[3])):
                            gradient[name] = gradient.get(name, 0.0) + target - p
                for name, g in gradient.items():
                    w = self.weights.get(name, 0.0)
                    g -= decay * w
                    squares[name] = squares.get(name, 1e-2) + g * g
                    self.weights[name] = w + rate * g / math.sqrt(squares[name])
        return self


# ------------------------------------------------------------------ training rows


def respelled(text: str, spans: list[Span], seed: int) -> tuple[str, list[Span]]:
    """The text with its labelled spans written another way, and the spans moved along."""
    out, moved, last = [], [], 0
    size = 0
    for k, (kind, a, b) in enumerate(sorted(spans, key=lambda s: s[1])):
        if a < last:
            return text, spans
        value, way = text[a:b], (seed + k) % 4
        digits = _NOT_DIGIT.sub("", value)
        if kind == "email":
            name, _, host = value.partition("@")
            value = [f"{name} (at) {host}", f"{name}[at]{host.replace('.', '[dot]')}", f"{name} @ {host}", f"{name} [at] {host.replace('.', ' [dot] ')}"][way]
        elif kind == "ip":
            value = [value.replace(".", "[.]"), value.replace(".", " . "), value.replace(".", "(dot)"), value][way]
        elif kind == "card":
            value = [".".join(re.findall("....|.+", digits)), "/".join(re.findall("....|.+", digits)), "  ".join(re.findall("....|.+", digits)), " - ".join(re.findall("....|.+", digits))][way]
        else:
            tail = digits[-10:]
            value = [f"({tail[:3]}) {tail[3:6]}-{tail[6:]}", f"{tail[:3]}-{tail[3:6]}-{tail[6:]}", f"{tail[:3]}.{tail[3:6]}.{tail[6:]}", f"{digits[:-10] or 1}-{tail[:3]}-{tail[3:6]}-{tail[6:]}"][way]
        out.append(text[last:a])
        size += a - last
        moved.append((kind, size, size + len(value)))
        out.append(value)
        size += len(value)
        last = b
    return "".join([*out, text[last:]]), moved


def spoiled(text: str, spans: list[Span]) -> str:
    """The text with its labelled numbers made invalid: a part over 255, a wrong check digit."""
    out, last = [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        value = text[a:b]
        if kind == "ip":
            value = value.rpartition(".")[0] + ".476"
        elif kind == "card":
            value = value[:-1] + str((int(value[-1]) + 1) % 10)
        elif kind == "phone":
            value = value[: len(value) // 2] + "x" + value[len(value) // 2 :]
        else:
            value = value.replace("@", " ")
        out += [text[last:a], value]
        last = b
    return "".join([*out, text[last:]])


def windows(text: str, around: int = 40, gap: int = 80) -> Iterator[str]:
    """Pieces of the text around digits and at signs."""
    start = end = -1
    for m in re.finditer(r"[0-9@]+", text):
        if start < 0:
            start = max(0, m.start() - around)
        elif m.start() - end > gap or end - start > 400:
            yield text[start : end + around]
            start = max(0, m.start() - around)
        end = m.end()
    if start >= 0:
        yield text[start : end + around]


def training_rows(pieces: list[str]) -> list[tuple[str, list[Span]]]:
    """Labelled pieces, and respelled copies of those that hold personal data."""
    rows = []
    for k, piece in enumerate(pieces):
        spans = base_spans(piece)
        rows.append((piece, spans))
        apart = all(a[2] <= b[1] for a, b in zip(sorted(spans, key=lambda s: s[1]), sorted(spans, key=lambda s: s[1])[1:], strict=False))
        if spans and apart:
            copy, moved = respelled(piece, spans, k)
            rows.append((copy, moved))
            wrong = [spoiled(piece, spans)]
            if all(s[0] in ("card", "phone") for s in moved):
                wrong.append(spoiled(copy, moved))
            rows += [(w, base_spans(w)) for w in wrong]
    return rows


def learn(docs: DataFrame, text: str = "text", rows: int = FIT_WINDOWS) -> SemiMarkovField:
    """Fit the field on a bounded sample of pieces in hash order."""
    ready(docs.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [w for t in batch.column(0).to_pylist() if t for w in windows(t)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["piece"])

    pieces = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(step, "piece string")
    chosen = first_by_hash(staged(pieces.distinct(), "pieces"), "piece", rows)
    return SemiMarkovField().fit(training_rows(chosen))


# ------------------------------------------------------------------ the operator


def all_spans(text: str, field: SemiMarkovField) -> list[tuple[str, int, int, bool]]:
    """Base spans and what the field adds, by kind and start; the flag marks base spans."""
    base = base_spans(text)
    added = []
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    reach = [-1, *accumulate((b for _, b in taken), max)]  # furthest end of the spans up to each
    for kind, a, b in field.decode(text):
        if reach[bisect_left(starts, b)] <= a:
            added.append((kind, a, b, False))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted([(*s, True) for s in base] + added, key=lambda s: (order[s[0]], s[1], s[2]))


SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def find_spans(docs: DataFrame, field: SemiMarkovField, text: str = "text") -> DataFrame:
    """The documents with ``spans``: kind, start, end and whether a fixed pattern gave it."""
    kept = [c for c in docs.columns if c != "spans"]
    source = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema.fields]
    entry = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b, "base": flag} for k, a, b, flag in all_spans(t, field)]
                for t in batch.column(len(kept)).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.list_(entry))], names=[*kept, "spans"]
            )

    return source.mapInArrow(step, ", ".join([*kinds, f"spans {SPANS}"]))


def written(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and the digest cover base spans; ``spans`` holds all."""
    docs = table(spark, sf_dir, "documents")
    found = find_spans(docs.select("doc_id", "text"), learn(docs)).drop("text")
    count = "CAST(size(filter(spans, s -> s.base AND s.kind = '{0}')) AS BIGINT) AS n_{0}"
    return found.selectExpr(
        "doc_id",
        *[count.format(kind) for kind in KINDS],
        f"sha2({written('filter(spans, s -> s.base)')}, 256) AS base_sha256",
        f"{written('spans')} AS spans",
        "CAST(size(filter(spans, s -> NOT s.base)) AS BIGINT) AS n_added",
    )
