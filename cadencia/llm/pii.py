"""Personal data by weak supervision: labelers vote on spans, EM weighs them, a classifier decides."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadencia.llm.common import bounded_batches
from cadencia.session import materialize

#: In the order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)
LABELERS = 5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9][0-9.]+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Looser patterns, for spans that the base ones miss.
_LOOSE_PHONE = re.compile(r"(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])")
_SPELLED_EMAIL = re.compile(r"[A-Za-z0-9_%+-]+ ?[\[(]at[\])] ?[A-Za-z0-9-]+(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]+)+")
_IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_ASSIGNED = re.compile(r"[=:]\s{0,3}[\"']?([A-Za-z0-9_/+-]{16,})")

# Words that speak for a kind when they stand before a span, and words that speak against any.
_CUES = {
    EMAIL: ("mail", "email", "contact", "write", "courriel", "correo"),
    IP: ("ip", "host", "server", "address", "login"),
    CARD: ("card", "visa", "mastercard", "payment", "karte", "carte", "tarjeta"),
    PHONE: ("phone", "tel", "call", "mobile", "fax", "whatsapp"),
    SECRET: ("token", "key", "secret", "password", "passwd", "pwd", "bearer"),
}
_AGAINST = ("version", "isbn", "page", "order", "invoice", "section", "figure", "checksum", "commit")
_WORD = re.compile(r"[a-z]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches in linear time: from every @ back over its local part."""
    floor, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > floor and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at) if begin < at else None
        if found:
            floor = found.end()
            yield begin, floor
        at = text.find("@", found.end() if found else at + 1)


def _octets(text: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in text.split(".")]
    return all(len(p) <= 3 and int(p) <= 255 for p in parts)


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, kind, end) of the base definitions, and matches of a card's form that fail its check."""
    found, failed = [], []
    if "@" in text:
        found += [(b, EMAIL, e) for b, e in _emails(text)]
    for run in _DOTTED.finditer(text):
        if run.group().count(".") >= 3:
            found += [(run.start() + m.start(), IP, run.start() + m.end()) for m in _IP.finditer(run.group()) if _octets(m.group())]
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19:
                (found if _luhn(digits) else failed).append((m.start(), CARD, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), PHONE, m.end()))
    return sorted(found), failed


def _loose_spans(text: str, base: list[tuple[int, int, int]], failed: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    more = list(failed)
    more += [(m.start(), PHONE, m.end()) for m in _LOOSE_PHONE.finditer(text)]
    if "[at]" in text or "(at)" in text:
        more += [(m.start(), EMAIL, m.end()) for m in _SPELLED_EMAIL.finditer(text)]
    if text.count(":") >= 7:
        more += [(m.start(), IP, m.end()) for m in _IPV6.finditer(text)]
    if "=" in text or ":" in text:
        more += [(m.start(1), SECRET, m.end(1)) for m in _ASSIGNED.finditer(text)]
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))  # the furthest end of the base spans so far
    out, last = [], 0
    for s, k, e in sorted(more):
        before = bisect_left(starts, e)
        if s >= last and not (before and reach[before - 1] > s):
            out.append((s, k, e))
            last = e
    return out


def _votes(text: str, start: int, kind: int, end: int, is_base: bool) -> int:
    """Votes of the labelers (-1, 0, 1) and properties of the span, as one number."""
    span, before = text[start:end], text[max(0, start - 40) : start].lower()
    digits = _digits(span)
    words = _WORD.findall(before)[-4:]
    strict = 1 if is_base else 0
    if kind == CARD:
        check = 1 if _luhn(digits) else -1
    elif kind == PHONE:
        check = 1 if 9 <= len(digits) <= 15 else -1
    elif kind == SECRET:
        check = 1 if digits and len(digits) < len(span) and len(set(span)) >= 8 else -1
    else:
        check = 1 if "." in span or ":" in span or "dot" in span else -1
    gazetteer = 1 if any(w in _CUES[kind] for w in words) else -1 if any(w in _AGAINST for w in words) else 0
    left, right = text[start - 1 : start], text[end : end + 1]
    context = -1 if (left.isalnum() or left in ("_", "/", "#")) or right.isalnum() or right in ("_", "/") else 1
    variety = -1 if len(digits) >= 8 and len(set(digits)) <= 2 else 0 if len(set(span)) < 6 else 1
    code = 0
    for vote in (strict, check, gazetteer, context, variety):
        code = code * 3 + vote + 1
    traits = (any(c in " .()-" for c in span), len(span) >= 16, text[max(0, start - 1) : start] in ("", "\n"), any(c.isalpha() for c in span))
    for trait in traits:
        code = code * 2 + trait
    return code * len(KINDS) + kind


def _decode(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind, rest = codes % len(KINDS), codes // len(KINDS)
    traits = np.stack([(rest >> i) & 1 for i in range(4)], 1)
    rest = rest >> 4
    votes = np.stack([rest // 3**i % 3 - 1 for i in reversed(range(LABELERS))], 1)
    return kind, votes, traits


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Probability of each vote pattern to be personal data: EM over patterns and their counts.

    The model has a prior and, for each labeler, the chance of each vote given the truth; it starts from the majority.
    """
    truth = 1 / (1 + np.exp(-votes.sum(1).astype(float)))
    for _ in range(rounds):
        log = np.zeros((len(votes), 2))
        for y in (0, 1):
            weight = counts * (truth if y else 1 - truth)
            log[:, y] += np.log((weight.sum() + 1) / (counts.sum() + 2))
            for j in range(votes.shape[1]):
                share = np.array([weight[votes[:, j] == v].sum() + 1 for v in (-1, 0, 1)])
                log[:, y] += np.log(share / share.sum())[votes[:, j] + 1]
        truth = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -30, 30)))
    return truth


def fit_classifier(kind: np.ndarray, votes: np.ndarray, traits: np.ndarray, soft: np.ndarray, counts: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Probabilities of a logistic regression on votes, traits and kind, fitted to the soft labels by Newton steps."""
    x = np.hstack([np.ones((len(kind), 1)), kind[:, None] == np.arange(len(KINDS)), votes == 1, votes == -1, traits]).astype(float)
    w, scale = np.zeros(x.shape[1]), counts / max(counts.sum(), 1) * 1000
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (scale * (p - soft)) + ridge * w
        hessian = (x * (scale * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(hessian, gradient)
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per input row: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    Base spans follow fixed patterns, whole text, leftmost and without overlap within a kind; matches that fail their check are
    dropped. Looser patterns propose more spans where no base span lies: spelled-out addresses, numbers without a
    country code or with a wrong check digit, IPv6, assigned secrets. Labelers (pattern, validity, gazetteer of cue
    words, context, variety) vote on every span; votes are counted over all documents, EM estimates how reliable each
    labeler is, and a classifier trained on its probabilities keeps proposed spans at ``threshold`` or more. Base spans always
    stay. Offsets are code points, ends exclusive. Null and empty texts have no spans. Repeated rows count
    each; an empty table gives an empty result. Other columns are not read.

    One pass over the texts writes spans with their votes; only counts of vote patterns (a number bounded by the
    labelers) are shuffled and reach the driver.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counted = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS[:4]]
    kept = [source.schema["doc_id"], *counted, T.StructField("base_sha256", T.StringType())]
    arrays = [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("starts", "ends", "codes")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            for value in batch.column(1):
                text = value.as_py() or ""
                base, failed = base_spans(text)
                more = _loose_spans(text, base, failed)
                for k in range(4):
                    columns[k].append(sum(x[1] == k for x in base))
                columns[4].append(hashlib.sha256(_listed(base).encode()).hexdigest())
                columns[5].append([x[0] for x in (*base, *more)])
                columns[6].append([x[2] for x in (*base, *more)])
                columns[7].append([_votes(text, *x, i < len(base)) for i, x in enumerate((*base, *more))])
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int32())] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=[f.name for f in (*kept, *arrays)],
            )

    scanned = materialize(source.mapInArrow(scan, T.StructType([*kept, *arrays])), "pii-spans")
    patterns = scanned.select(F.explode("codes").alias("code")).groupBy("code").count().orderBy("code").collect()
    chances: dict[int, float] = {}
    if patterns:
        codes, counts = np.array([r["code"] for r in patterns]), np.array([r["count"] for r in patterns], float)
        kind, votes, traits = _decode(codes)
        chances = dict(zip(codes.tolist(), fit_classifier(kind, votes, traits, reliabilities(votes, counts), counts).tolist()))
    shared = spark.sparkContext.broadcast(chances)
    strict_at = 3 ** (LABELERS - 1) * 16 * len(KINDS)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for starts, ends, codes in zip(*(batch.column(n).to_pylist() for n in ("starts", "ends", "codes"))):
                lists.append(_listed([
                    (s, c % len(KINDS), e) for s, e, c in zip(starts, ends, codes)
                    if c // strict_at % 3 == 2 or shared.value[c] >= threshold
                ]))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(lists, pa.string())], names=[*[f.name for f in kept], "spans"])

    return scanned.mapInArrow(decide, T.StructType([*kept, T.StructField("spans", T.StringType())]))
