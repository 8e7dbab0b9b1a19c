"""Secret scans: patterns find candidates, a random forest removes what isn't one.

The forest sees a candidate's length, how its characters follow one another, how much of it a dictionary covers, whether
it is part of a path, and the words around it. It learns from labelled findings: keys and passwords of common forms in
the places where they leak, and what is mistaken for them (long words, hashes that name a version, paths, identifiers,
placeholders). They are drawn from a fixed seed, as no table holds such labels; a caller can pass others.
"""

import functools
import random
import re
import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pyspark.sql import functions as F

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}+")
KEYED = re.compile(r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s{0,4}[:=]\s{0,4}[\"']?([^\s\"',;]{8,}+)")
#: A name that is glued to its value in one run.
NAMED = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*+=(?=[^=]{16})")
KEY = re.compile(r"(?i)passw|pwd|secret|token|api_?-?key|access_?-?key")
# Words that announce a secret, words that announce something else, common words, placeholders.
BEFORE = ("token", "secret", "password", "passwd", "pwd", "api", "key", "apikey", "auth", "bearer", "credential", "private")
OTHER = ("commit", "sha", "sha1", "sha256", "md5", "version", "revision", "uuid", "id", "hash", "checksum", "digest", "build", "etag")
WORDS = frozenset(
    "the and that with this from have for are was were not you all any can her his one our out day get has him how man new now old see two way who "
    "test data file name path user group index value table model class function object string number default example config system network service "
    "server client request response message error handler manager factory builder controller module package version image document content page "
    "der die das und ein eine nicht mit von les des une est pour dans que los las del con una por para".split()
)
PLACEHOLDER = re.compile(r"(?i)your|example|changeme|placeholder|insert|dummy|sample|x{4,}|\*{3,}|<|\$\{|1234")
TREES, DEPTH, ACCEPT, FINDINGS = 40, 8, 0.5, 4000
#: Longer values are judged in overlapping parts too, of PART characters.
LONGEST, PART = 128, 64


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(text: str, start: int, end: int, a: int | None = None, b: int | None = None) -> list[float]:
    """Of text[start:end], or of its part text[a:b] with the surroundings of the whole."""
    a, b = (start, end) if a is None else (a, b)
    value = text[a:b]
    n = len(value)
    kinds = [_class(c) for c in value]
    turns = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    p = np.array(list(Counter(value).values())) / n
    low = value.lower()
    covered, at = 0, 0
    while at < n:
        size = next((k for k in range(min(10, n - at), 2, -1) if low[at : at + k] in WORDS), 0)
        covered += size
        at += size or 1
    vowels = sum(c in "aeiou" for c in low)
    letters = sum(c.isalpha() for c in low)
    before = re.findall(r"[A-Za-z0-9]+", text[max(0, start - 40) : start])[-3:]
    words = {w.lower() for w in before}
    lead, trail = text[max(0, start - 1) : start], text[end : end + 1]
    assigned = bool(re.search(r"[:=]\s*[\"']?$", text[max(0, start - 6) : start]))
    pairs = list(zip(kinds, kinds[1:], strict=False))
    return [
        float(np.log2(b - a)),
        turns / max(1, n - 1),
        float(-(p * np.log2(p)).sum()),
        sum(k == 2 for k in kinds) / n,
        sum(k == 1 for k in kinds) / n,
        sum(k == 3 for k in kinds) / n,
        covered / n,
        vowels / max(1, letters),
        sum(x != y and 2 in (x, y) for x, y in pairs) / max(1, n - 1),
        float(value.count("/") + value.count(".")),
        float(bool(re.fullmatch(r"[0-9a-fA-F]+", value))),
        float(bool(words & set(BEFORE))),
        float(bool(words & set(OTHER))),
        float(assigned),
        float(lead in ("'", '"') and trail in ("'", '"')),
        float(bool(PLACEHOLDER.search(value))),
    ]


def labelled_findings(n: int = FINDINGS, seed: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of n findings, half of each kind."""
    rng = random.Random(seed)
    pick = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    hexa, alnum, b64 = "0123456789abcdef", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"
    syllables = "an er th in on re ed ti es st en nd ha ou le la de qu ch ge be ei ver zu ci sa lo mi ta".split()
    word = lambda a, b: "".join(rng.choice(syllables) for _ in range(rng.randint(a, b)))
    prose = lambda: " ".join(word(1, 4) for _ in range(rng.randint(3, 8)))
    case = lambda s: s.upper() if rng.random() < 0.15 else s
    secrets = [
        lambda: pick(hexa, rng.choice((32, 40, 40, 40, 64))),
        lambda: pick(alnum, rng.randint(20, 64)),
        lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16),
        lambda: "ghp_" + pick(alnum, 36),
        lambda: pick(b64, rng.choice((40, 43))) + "=",
        lambda: "eyJ" + pick(alnum, 33) + "." + pick(alnum, 40) + "." + pick(alnum, 43),
        lambda: word(2, 3).capitalize() + pick(string.digits, 3) + pick("_+-", 1) + pick(alnum, 5),
        lambda: word(2, 4).capitalize() + pick(string.digits, rng.randint(1, 3)) + pick("&%!$@^*", 1) + pick(alnum + "-&%!", rng.randint(3, 20)),
        lambda: pick("=-_.", 1) * rng.randint(4, 32) + pick(rng.choice((hexa, alnum)), rng.randint(32, 40)),
        lambda: word(2, 4).capitalize() + pick(string.digits, 1) + word(1, 3) + pick("&%!$@^*", 1) + pick(string.digits, rng.randint(1, 3)) + "-" + word(2, 5),
    ]
    wrong = [
        lambda: word(6, 11),
        lambda: word(6, 11).capitalize(),
        lambda: "/".join(word(2, 4) for _ in range(rng.randint(3, 5))) + "." + rng.choice(("py", "html", "txt")),
        lambda: "_".join(word(2, 3) for _ in range(3)),
        lambda: "".join(word(2, 3).capitalize() for _ in range(3)),
        lambda: "-".join(pick(hexa, k) for k in (8, 4, 4, 4, 12)),
        lambda: rng.choice(("your_api_key_here", "xxxxxxxxxxxxxxxxxxxx", "example-token-value", "changeme_changeme")),
        lambda: pick("=-_.", 1) * rng.randint(16, 60),
        lambda: pick(string.digits, rng.randint(16, 20)),
        lambda: "www." + word(2, 4) + ".example.com/" + word(3, 5),
    ]
    x, y = [], []
    for i in range(n):
        good = i % 2
        if good:
            value, name = rng.choice(secrets)(), rng.choice(BEFORE)
            lead = rng.choice((f'{name} = "', f"{name}: ", f"{name}=", f'"{name}": "', f"{name} = '", f"{name} "))
        elif rng.random() < 0.15:
            value, lead = pick(hexa, rng.choice((32, 40, 64))), rng.choice(OTHER) + rng.choice((" ", ": ", "="))
        else:
            value, k = (f := rng.choice(wrong))(), rng.random()
            placeholder = f is wrong[6]
            lead = f'{rng.choice(BEFORE)} = "' if placeholder and k < 0.8 or k < 0.05 and f is not wrong[8] else f'{word(1, 3)} = "' if k < 0.15 else ""
        trail = '"' if lead.endswith('"') else "'" if lead.endswith("'") else ""
        head = case(f"{prose()} {lead}")
        if not good and value.isalpha():
            value = case(value)
        x.append(features(f"{head}{value}{trail} {prose()}", len(head), len(head) + len(value)))
        y.append(good)
    return np.array(x), np.array(y, float)


class Forest:
    """Each tree grows on a bootstrap sample; each split is the best of a few thresholds of a few features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.trees = []
        for _ in range(trees):
            own = rng.integers(0, len(x), len(x))
            nodes: list[list] = []
            self._grow(x[own], y[own], depth, rng, nodes)
            self.trees.append(tuple(np.array(c) for c in zip(*nodes, strict=True)))

    def _grow(self, x, y, depth, rng, nodes) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, 0, 0, float(y.mean())])
        if depth == 0 or len(y) < 8 or y.min() == y.max():
            return me
        best = (2.0, 0, 0.0)
        for f in rng.choice(x.shape[1], max(1, round(x.shape[1] ** 0.5)), replace=False):
            for t in np.unique(np.quantile(x[:, f], (0.05, 0.15, 0.3, 0.5, 0.7, 0.85, 0.95))):
                left = x[:, f] <= t
                k = left.sum()
                if 0 < k < len(y):
                    a, b = y[left].mean(), y[~left].mean()
                    gini = (k * a * (1 - a) + (len(y) - k) * b * (1 - b)) / len(y)
                    best = min(best, (float(gini), int(f), float(t)))
        if best[0] > 1:
            return me
        left = x[:, best[1]] <= best[2]
        nodes[me][:2] = [best[1], best[2]]
        nodes[me][2] = self._grow(x[left], y[left], depth - 1, rng, nodes)
        nodes[me][3] = self._grow(x[~left], y[~left], depth - 1, rng, nodes)
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The share of trees' votes, each weighed by its leaf's."""
        total = np.zeros(len(x))
        for feature, cut, left, right, value in self.trees:
            at = np.zeros(len(x), int)
            while (inner := feature[at] >= 0).any():
                go = x[np.arange(len(x)), np.maximum(feature[at], 0)] <= cut[at]
                at = np.where(inner, np.where(go, left[at], right[at]), at)
            total += value[at]
        return total / len(self.trees)


@functools.cache
def default_forest() -> Forest:
    return Forest(*labelled_findings())


def _is_run(run: str) -> bool:
    return len(run) >= 16 and (any(c.isdigit() for c in run) or run.count("=") < len(run) // 2 and not run.isalpha())


def candidates(text: str) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Runs that could be keys, and values that a name announces, each with the spans that are judged for it.

    A value that touches runs is one candidate with them, judged as a whole and by each; names glued to a value are cut off,
    and are candidates of their own if they could be keys. Candidates don't overlap.
    """
    values = [(m.start(), *m.span(1)) for m in KEYED.finditer(text)] if KEY.search(text) else []
    out: list[tuple[int, int, list[tuple[int, int]]]] = [(a, b, [(a, b)]) for _, a, b in values]
    at = 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(values) and values[at][2] <= start:
            at += 1
        # A run's pieces: before each announced value's name, and within the value. A run can't go on after a value's end.
        k = at
        while start < end and k < len(values) and values[k][0] < end:
            name, a, b = values[k]
            if start < name:
                out += _pieces(text, start, name)
            out[k][2].extend(part for _, _, own in _pieces(text, max(start, a), min(end, b)) for part in own)
            start, k = max(start, min(end, b)), k + 1
        out += _pieces(text, start, end)
    return sorted(out)


def _pieces(text: str, start: int, end: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Those of a run without an announced value that could be keys: itself, or a name and what it is glued to."""
    out = []
    while m := NAMED.match(text, start, end):
        if _is_run(text[start : m.end() - 1]):
            out.append((start, m.end() - 1, [(start, m.end() - 1)]))
        start = m.end()
    return out + ([(start, end, [(start, end)])] if _is_run(text[start:end]) else [])


def _parts(text: str, parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans to judge: each, and overlapping parts of a long one; of equal parts, as rulers have, the first alone."""
    out = dict.fromkeys(parts)
    for a, b in list(out):
        if b - a > LONGEST:
            starts = [*range(a, b - PART, PART // 2), b - PART]
            out |= dict.fromkeys((i, i + PART) for i in {text[i : i + PART]: i for i in reversed(starts)}.values())
    return list(out)


def secrets(texts: list[str | None], forest: Forest) -> list[tuple[int, list[tuple[int, int]]]]:
    """Of each text: the number of candidates, and the spans of those of which the forest accepts any part."""
    own = [candidates(t or "") for t in texts]
    flat = [(i, a, b, part) for i, found in enumerate(own) for a, b, parts in found for part in _parts(texts[i], parts)]
    out: list[tuple[int, list]] = [(len(found), []) for found in own]
    if flat:
        p = forest.predict(np.array([features(texts[i], a, b, *part) for i, a, b, part in flat]))
        for i, a, b in dict.fromkeys((i, a, b) for (i, a, b, _), q in zip(flat, p, strict=True) if q >= ACCEPT):
            out[i][1].append((a, b))
    return out


def scan(docs: DataFrame, forest: Forest | None = None) -> DataFrame:
    """One row a document (doc_id, text): n_candidates, n_secrets and their spans, "start:end" by comma, in code points.

    A null text counts as empty. Repeated rows get equal results. No rows give none.
    """
    forest = forest or default_forest()

    def run(batches):
        for batch in batches:
            got = secrets(batch.column(1).to_pylist(), forest)
            cols = [pa.array([n for n, _ in got], pa.int64()), pa.array([len(s) for _, s in got], pa.int64()), pa.array([",".join(f"{a}:{b}" for a, b in s) for _, s in got], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", "n_candidates", "n_secrets", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_candidates long, n_secrets long, spans string")


def redacted(docs: DataFrame, mask: str = "<SECRET>", forest: Forest | None = None) -> DataFrame:
    """docs with every secret in `text` replaced by mask, and n_chars, where there is one, counted anew."""
    forest = forest or default_forest()
    names = docs.columns
    at = names.index("text")
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, (_, spans) in enumerate(secrets(texts, forest)):
                for a, b in reversed(spans):
                    texts[i] = texts[i][:a] + mask + texts[i][b:]
            cols = list(batch.columns)
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, names)

    out = docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out
