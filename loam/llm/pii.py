"""Personal data by weak supervision.

Fixed patterns find base spans, which always stay. Looser patterns find further candidates. Five labelers vote on every
candidate: the strict pattern, a check of the value, a gazetteer, the words before it, and how it is set off from its
surroundings. Expectation-maximisation over the counts of all vote patterns estimates each labeler's reliability for each
kind; the posteriors then train a logistic span classifier over votes and shape, and candidates that it accepts are added.
"""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import saved

KINDS = ("email", "ip", "card", "phone")
#: A candidate is added from this probability on.
ACCEPT = 0.9
NEAR = 48
# The base patterns, written so that a failed run isn't tried again from its middle.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile("[0-9]")
# Looser forms.
AT = re.compile(r"([\[({]\s?at\s?[\])}]|\sat\s)", re.I)
DOT = re.compile(r"(?:\s?[\[({]\s?dot\s?[\])}]\s?|\s{1,2}dot\s{1,2}|\.)", re.I)
SPELLED = re.compile(r"[\[({]\s?dot\s?[\])}]|\sdot\s", re.I)
RIGHT = re.compile(rf"\s?[A-Za-z0-9-]++(?:{DOT.pattern}[A-Za-z0-9-]++)++", re.I)
LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z])")
# Gazetteers: common endings of host names, first digits of card issuers, words that announce a kind.
ENDINGS = frozenset("com org net edu gov io info biz de fr es it uk us eu ch at nl be pl se no dk fi pt br mx ca au jp cn in ru".split())
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65", "35", "30", "36", "38")
CONTEXT = (
    frozenset("mail email e-mail contact write courriel correo kontakt reach".split()),
    frozenset("ip host server address addr adresse dirección gateway node from".split()),
    frozenset("card visa mastercard amex credit debit carte karte tarjeta payment kreditkarte".split()),
    frozenset("call phone tel telephone mobile cell fax téléphone appelez telefon anruf teléfono móvil handy".split()),
)
LETTERS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _ip_fits(text: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in text.split(".")))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), leftmost and not overlapping within a kind."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((0, start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    if DIGITS.search(text):
        out += [(1, m.start(), m.end()) for m in IP.finditer(text) if _ip_fits(m[0])]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return out


def _loose(text: str) -> list[tuple[int, int, int]]:
    out, last = [], 0
    for m in AT.finditer(text):
        # Neither an "at" nor what was taken before is part of a name, so that no character is looked at twice.
        end = m.start() - (m.start() > last and text[m.start() - 1].isspace())
        start = end
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < end and (b := RIGHT.match(text, m.end())) and (m[0].strip()[0] in "[({" or SPELLED.search(b[0])):
            out.append((0, start, b.end()))
            last = b.end()
        else:
            last = m.end()
    if DIGITS.search(text):
        out += [(1, m.start(), m.end()) for m in IP.finditer(text)]
        out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(_digits(m[0])) <= 19]
        out += [(3, m.start(), m.end()) for m in LOCAL_PHONE.finditer(text)]
    return out


def votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, ...]:
    """1 for, -1 against, 0 for nothing: pattern, value, gazetteer, words before, surroundings; then the shape, 0 to 3."""
    value, digits = text[start:end], _digits(text[start:end])
    before, after = text[max(0, start - NEAR) : start], text[end : end + 1]
    words = {w.lower() for w in LETTERS.findall(before)[-5:]}
    ours, others = words & CONTEXT[kind], any(words & c for k, c in enumerate(CONTEXT) if k != kind)
    checks = (
        0,
        1 if kind == 1 and _ip_fits(value) else -1,
        1 if luhn(digits) else -1,
        1 if 10 <= len(digits) <= 15 and len(set(digits)) > 3 else -1,
    )
    named = (
        1 if re.split(r"[^A-Za-z]+", value.rstrip())[-1].lower() in ENDINGS else -1,
        0,
        1 if digits.startswith(ISSUERS) else -1,
        0,
    )
    apart = (not before or not before[-1].isalnum()) and (not after or not after.isalnum())
    shape = min(3, sum(c in " -.()" for c in value) // 2)
    return (1 if base else -1, checks[kind], named[kind], 1 if ours else -1 if others else 0, 1 if apart else -1, shape)


def scan(text: str | None) -> tuple[list[int], list[int], list[int]]:
    """Base spans, further candidates with a code for their votes, and the codes of the base spans' votes."""
    text = text or ""
    base = base_spans(text)
    taken = {k: [s[1:] for s in base if s[0] == k] for k in range(len(KINDS))}
    more = [c for c in _loose(text) if all(c[2] <= a or c[1] >= b for a, b in taken[c[0]])]
    return (
        [v for s in base for v in s],
        [v for s in more for v in (*s, encode(s[0], votes(text, *s, False)))],
        [encode(s[0], votes(text, *s, True)) for s in base],
    )


def encode(kind: int, vote: tuple[int, ...]) -> int:
    code = kind
    for v in vote[:5]:
        code = code * 3 + v + 1
    return code * 4 + vote[5]


def decode(code: int) -> tuple[int, list[int], int]:
    code, shape = divmod(code, 4)
    out = []
    for _ in range(5):
        code, v = divmod(code, 3)
        out.append(v - 1)
    return code, out[::-1], shape


def reliabilities(counts: dict[int, int], rounds: int = 50) -> dict[int, float]:
    """Posterior of each code, by expectation-maximisation within each kind: votes are independent given the truth."""
    out = {}
    for kind in range(len(KINDS)):
        codes = [c for c in counts if decode(c)[0] == kind]
        if not codes:
            continue
        v = np.array([decode(c)[1] for c in codes])
        n = np.array([counts[c] for c in codes], float)
        post = 1 / (1 + np.exp(-v.sum(1).astype(float)))
        for _ in range(rounds):
            share = np.clip((n * post).sum() / n.sum(), 0.01, 0.99)
            log = np.full(len(codes), np.log(share / (1 - share)))
            for j in range(v.shape[1]):
                for value in (-1, 0, 1):
                    at = v[:, j] == value
                    true = ((n * post)[at].sum() + 1 + (value == 1)) / ((n * post).sum() + 4)
                    false = ((n * (1 - post))[at].sum() + 1 + (value == -1)) / ((n * (1 - post)).sum() + 4)
                    log[at] += np.log(true / false)
            post = 1 / (1 + np.exp(-np.clip(log, -30, 30)))
        out |= dict(zip(codes, post.tolist(), strict=True))
    return out


def classifier(counts: dict[int, int], truth: dict[int, float], rounds: int = 30) -> dict[int, float]:
    """The span classifier's probability of each code: logistic regression, by Newton's method, on the posteriors."""

    def features(code: int) -> list[float]:
        kind, vote, shape = decode(code)
        return [1.0, *(float(x == y) for x in vote for y in (-1, 1)), *(float(kind == k) for k in range(1, 4)), *(float(shape == s) for s in (1, 2, 3))]

    codes = sorted(counts)
    if not codes:
        return {}
    x, y = np.array([features(c) for c in codes]), np.array([truth[c] for c in codes])
    n = np.array([counts[c] for c in codes], float)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (y - p)) - 0.1 * w
        w = w + np.linalg.solve((x.T * (n * p * (1 - p) + 1e-9)) @ x + 0.1 * np.eye(len(w)), grad)
    return dict(zip(codes, (1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))).tolist(), strict=True))


def personal_data(docs: DataFrame) -> DataFrame:
    """One row a document (doc_id, text): the number of base spans by kind, their digest, all spans, and their number.

    A null text counts as empty and has no spans; a null doc_id stays null. Repeated rows get equal results. Spans count code
    points, their ends excluded, and may be of any length. Other columns are ignored, whatever their names. No rows give none.
    """

    def find(batches):
        for batch in batches:
            got = [scan(t) for t in batch.column(1).to_pylist()]
            cols = [pa.array([g[i] for g in got], pa.list_(pa.int32())) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", "base", "more", "codes"])

    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    found = saved(ids.mapInArrow(find, "doc_id long, base array<int>, more array<int>, codes array<int>"))

    def tally(batches):
        total: Counter = Counter()
        for batch in batches:
            for more, codes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total.update(codes)
                total.update(more[3::4])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], ["code", "n"])

    # There are at most 4 * 3^5 * 4 codes.
    tallied = found.select("more", "codes").mapInArrow(tally, "code int, n long").groupBy("code").sum("n").collect()
    counts = {r[0]: r[1] for r in tallied}
    likely = classifier(counts, reliabilities(counts))
    added = {c for c, p in likely.items() if p >= ACCEPT}

    def join(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted((a, k, b) for k, a, b in spans))

    def finish(batches):
        import hashlib

        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for base, more in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                spans = list(zip(base[::3], base[1::3], base[2::3], strict=True))
                for k in range(4):
                    cols[k].append(sum(s[0] == k for s in spans))
                extra = [(more[i], more[i + 1], more[i + 2]) for i in range(0, len(more), 4) if more[i + 3] in added]
                cols[4].append(hashlib.sha256(join(spans).encode()).hexdigest())
                cols[5].append(join(spans + extra))
                cols[6].append(len(spans) + len(extra))
            arrays = [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans"])

    return found.select("doc_id", "base", "more").mapInArrow(finish, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")
