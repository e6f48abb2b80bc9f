"""Personal data by weak supervision: regex, gazetteer and context labelers vote, expectation-maximisation
estimates how reliable each is, and a span classifier is trained on the estimated labels.

Base spans (strict patterns with checks) always stay. Candidates are the base spans, matches of a base
pattern that failed its check, and looser shapes (obfuscated addresses, numbers without a
country code, IPv6). Each labeler votes +1, -1 or 0 on a candidate. All that the model sees of a
candidate is its kind, its votes and a few classes of what the span itself looks like (its length, its share of digits,
the marks in it, whether it stands alone), so the corpus is summed up by counts of such patterns (some thousand at most,
whatever the corpus), over all documents. EM runs on the votes; the classifier, a logistic regression over kind, votes
and looks, learns the posteriors, so that spans of one vote pattern may be told apart by how they look. Candidates that
it gives at least 0.5 and that overlap no base span are added.

Offsets are code points, ends exclusive. Both passes are narrow; only counts are shuffled.

Defined results for odd input: null and empty texts have no spans (the hash of the empty string); a very long
text is searched whole, in time that grows with its length and the logarithm of its spans;
repeated rows give repeated results; a null doc_id is kept; an empty table gives no rows and a model without
additions; other columns are passed over (redact() keeps them).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ship, table

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "loose", "gazetteer", "context", "against", "edges")
#: Numbers of classes of each look.
LOOKS = (4, 4, 4, 2, 2)
THRESHOLD = 0.5
CONTEXT = 40

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A run of digits that cannot start a match at its first digit cannot at a later one.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_BRACKET_AT = re.compile(r"([A-Za-z0-9._%+-]{1,64})\x20?[\[({]\x20?(?:at|AT)\x20?[\])}]\x20?([A-Za-z0-9-]{1,63})(?:\x20?[\[({]\x20?(?:dot|DOT)\x20?[\])}]\x20?|\.)([A-Za-z]{2,24})")
_SPOKEN_AT = re.compile(r"([A-Za-z0-9._%+-]{1,64}) (?:at|AT) ([A-Za-z0-9-]{1,63}) (?:dot|DOT) ([A-Za-z]{2,24})\b")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])|(?<![0-9])00[1-9][0-9]{0,2}(?:[\x20-][0-9]{2,4}){2,4}(?![0-9])")
_IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_CUES = {
    "email": re.compile(r"(?i)mail|contact|write|reach|schreib|correo|courriel"),
    "ip": re.compile(r"(?i)\bip\b|server|host|address|adres|direc|login|from"),
    "card": re.compile(r"(?i)card|visa|master|amex|credit|karte|tarjeta|carte|pay"),
    "phone": re.compile(r"(?i)phone|tel|call|mobil|fax|ruf|llam|appel|whatsapp"),
}
_AGAINST = re.compile(r"(?i)version|\bv\.? ?$|isbn|order|invoice|sku|part no|section|chapter|build|release")
_TOP_LEVEL = frozenset("com net org edu gov int info biz io de fr es uk eu us ca au ch at nl be it pt mx ar cl co br in jp cn example".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from each at sign outwards: linear in the text."""
    free, at = 0, text.find("@")
    before = 0  # a local part holds no at sign
    while at >= 0:
        head = text[max(free, before) : at]
        local = len(head) - len(head.rstrip(_LOCAL))
        if local:
            m = _DOMAIN.match(text, at + 1)
            if m:
                yield at - local, m.end()
                free = m.end()
        before = at + 1
        at = text.find("@", before)


def shapes(text: str) -> list[tuple[int, int, str, bool]]:
    """All matches of the base patterns: start, end, kind, whether the check holds."""
    found = [(a, b, "email", True) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            found.append((m.start(), m.end(), "ip", all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 9:
                digits = m[0].replace(" ", "").replace("-", "")
                found.append((m.start(), m.end(), "card", 12 <= len(digits) <= 19 and luhn(digits)))
        if "+" in text:
            for m in _PHONE.finditer(text):
                found.append((m.start(), m.end(), "phone", 9 <= len(_DIGIT.findall(m[0])) <= 15))
    return found


def _loose(text: str) -> list[tuple[int, int, str]]:
    found = []
    if any(c in text for c in "[({"):
        found += [(m.start(), m.end(), "email") for m in _BRACKET_AT.finditer(text)]
    if " dot " in text or " DOT " in text:
        found += [(m.start(), m.end(), "email") for m in _SPOKEN_AT.finditer(text)]
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), "phone") for m in _LOCAL_PHONE.finditer(text)]
        if ":" in text:
            found += [(m.start(), m.end(), "ip") for m in _IPV6.finditer(text)]
    return found


def _gazetteer(kind: str, span: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[.\s\])}]", span)[-1].lower() in _TOP_LEVEL else -1
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return 0 if ":" in span else -1 if span.split(".")[0].lstrip("0") in ("", "255") else 1
    if kind == "card":
        return 1 if re.match("4|5[1-5]|2[2-7]|3[47]|6011|65", digits) else -1
    return 1 if 9 <= len(digits) <= 15 else 0


def votes(text: str, start: int, end: int, kind: str, strict: int, loose: int) -> tuple[int, ...]:
    left = text[max(0, start - CONTEXT) : start]
    near = left + " " + text[end : end + CONTEXT // 2]
    outside = text[start - 1 : start] + text[end : end + 1]
    return (strict, loose, _gazetteer(kind, text[start:end]), int(bool(_CUES[kind].search(near))), -int(bool(_AGAINST.search(left))), -1 if any(c.isalnum() for c in outside) else 1)


def overlap(spans: list[tuple]) -> Callable[[int, int], bool]:
    """Whether a range overlaps any of the spans; by halving, for spans sorted by start."""
    starts = [s[0] for s in spans]
    ends = list(accumulate((s[1] for s in spans), max))

    def found(a: int, b: int) -> bool:
        n = bisect_left(starts, b)
        return n > 0 and ends[n - 1] > a

    return found


def looks(text: str, start: int, end: int) -> tuple[int, ...]:
    """Classes of a span's looks: length, share of digits, separators, letters in it, line of its own."""
    span = text[start:end]
    digits = sum(c.isdigit() for c in span)
    marks = sum(not c.isalnum() for c in span)
    alone = (start == 0 or text[start - 1] == "\n") and (end == len(text) or text[end] == "\n")
    return (min(3, (end - start) // 8), min(3, 4 * digits // max(1, len(span))), min(3, marks), int(any(c.isalpha() for c in span)), int(alone))


def candidates(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str, tuple]]]:
    """Base spans, and all candidates with their pattern (kind and votes)."""
    text = text or ""
    found = shapes(text)
    base = sorted((a, b, k) for a, b, k, ok in found if ok)
    every = [(a, b, k, (k, *votes(text, a, b, k, 1 if ok else -1, 0), *looks(text, a, b))) for a, b, k, ok in found]
    taken = {(a, b, k) for a, b, k, _ in found}
    known = overlap(base)
    every += [(a, b, k, (k, *votes(text, a, b, k, 0, 1), *looks(text, a, b))) for a, b, k in _loose(text) if (a, b, k) not in taken and not known(a, b)]
    return base, every


def dawid_skene(patterns: list[tuple], counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, dict]:
    """EM over counted vote patterns: the probability that each pattern is personal data, and each
    labeler's reliability (how often its votes agree with the truth, by class). A labeler is never thought
    worse than chance, which keeps the classes from changing places."""
    kinds = np.array([KINDS.index(p[0]) for p in patterns])
    v = np.array([p[1 : 1 + len(LABELERS)] for p in patterns], np.int64).reshape(len(patterns), len(LABELERS))
    post = np.clip(0.5 + 0.2 * v.sum(1), 0.02, 0.98)
    good = np.full((len(LABELERS), 2), 0.75)
    for _ in range(rounds):
        for j in range(len(LABELERS)):
            plus, minus = counts * (v[:, j] > 0), counts * (v[:, j] < 0)
            good[j, 1] = (2 + (plus * post).sum()) / (3 + ((plus + minus) * post).sum())
            good[j, 0] = (2 + (minus * (1 - post)).sum()) / (3 + ((plus + minus) * (1 - post)).sum())
        good = np.clip(good, 0.5, 0.99)
        prior = np.array([(1 + (counts * post)[kinds == k].sum()) / (2 + counts[kinds == k].sum()) for k in range(len(KINDS))])
        log = np.log(prior[kinds]) - np.log(1 - prior[kinds])
        for j in range(len(LABELERS)):
            log = log + (v[:, j] > 0) * np.log(good[j, 1] / (1 - good[j, 0])) + (v[:, j] < 0) * np.log((1 - good[j, 1]) / good[j, 0])
        new = 1 / (1 + np.exp(-np.clip(log, -30, 30)))
        if np.abs(new - post).max(initial=0) < 1e-9:
            break
        post = new
    return post, {name: (round(float(good[j, 0]), 4), round(float(good[j, 1]), 4)) for j, name in enumerate(LABELERS)}


def _design(patterns: list[tuple]) -> np.ndarray:
    """Kind, votes for and against, and the classes of looks, one column each."""
    n = 1 + len(LABELERS)
    rows = [[float(p[0] == k) for k in KINDS] + [float(x > 0) for x in p[1:n]] + [float(x < 0) for x in p[1:n]] + [float(x == c) for x, m in zip(p[n:], LOOKS, strict=True) for c in range(1, m)] for p in patterns]
    return np.array(rows).reshape(len(patterns), len(KINDS) + 2 * len(LABELERS) + sum(m - 1 for m in LOOKS))


def fit(counts: dict[tuple, int]) -> dict[tuple, float]:
    """Pattern -> probability of the span classifier (logistic regression on EM's posteriors, Newton steps)."""
    if not counts:
        return {}
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    post, _ = dawid_skene(patterns, n)
    x = _design(patterns)
    w = np.zeros(x.shape[1])
    # Weights of patterns by the root of their counts: rare shapes are heard beside common ones.
    weight = np.sqrt(n)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - post)) + 0.01 * w
        h = (x.T * (weight * p * (1 - p))) @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step / max(1.0, np.abs(step).max() / 2)
    return {p: float(q) for p, q in zip(patterns, 1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), strict=True)}


def train(docs: DataFrame) -> dict[tuple, float]:
    """The classifier, from the vote patterns of all documents."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(c[3] for c in candidates(text)[1])
        yield pa.RecordBatch.from_pydict({"pattern": pa.array([" ".join(map(str, p)) for p in seen], pa.string()), "n": pa.array(seen.values(), pa.int64())})

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    parts = [(r["pattern"].split(" "), r["n"]) for r in counted]
    return fit({(p[0], *map(int, p[1:])): n for p, n in parts})


def all_spans(text: str | None, model: dict[tuple, float], threshold: float = THRESHOLD) -> tuple[list, list]:
    """Base spans and all spans, each as (start, end, kind) in order of start, then kind as listed."""
    base, every = candidates(text)
    spans, known, free = list(base), overlap(base), 0
    for a, b, k, pattern in sorted(every):
        # Base candidates overlap themselves; added spans come by start, so only the last end counts.
        if a >= free and model.get(pattern, 0.0) >= threshold and not known(a, b):
            spans.append((a, b, k))
            free = b
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    return sorted(base, key=order), sorted(spans, key=order)


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def find(docs: DataFrame, model: dict[tuple, float]) -> DataFrame:
    """docs(doc_id, text) -> doc_id, base and spans as arrays of (start, end, kind)."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [all_spans(x, held.value) for x in batch.column("text").to_pylist()]
            cols = [pa.array([[{"start": a, "end": b, "kind": k} for a, b, k in x[i]] for x in both], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=["doc_id", "base", "spans"])

    span = "array<struct<start:long,end:long,kind:string>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id long, base {span}, spans {span}")


def blank(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with each run of overlapping spans replaced by the name of its first kind."""
    if not spans:
        return text
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: dict[tuple, float]) -> DataFrame:
    """docs with spans blanked in text, other columns as they are."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)
    fields = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([blank(x, all_spans(x, held.value)[1]) for x in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if c == "text" else batch.column(c) for c in fields], names=fields)

    return docs.mapInArrow(run, docs.schema)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find(docs, train(docs))
    of_kind = lambda k: F.filter("base", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
