"""Secret scanning: candidate strings, then a random forest that removes false positives.

Candidates are long runs of token characters, strings with a known prefix and private-key blocks. The forest sees length,
character classes and transitions, dictionary coverage, the path (source) and the neighbouring words, and learns from
labelled findings: a table of its own, or findings generated by a seeded rule where none is given.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .trees import Forest, forest

#: Labelled findings to learn from at most, and the score that makes a secret.
MAX_FINDINGS, THRESHOLD = 20_000, 0.5

# Known prefixes, neighbouring words for and against, path parts, frequent words and letter pairs.
PREFIXES = {
    "aws_key": r"(?:AKIA|ASIA)[0-9A-Z]{16}", "github": r"gh[pousr]_[0-9A-Za-z]{30,}", "slack": r"xox[abprs]-[0-9A-Za-z-]{10,}", "google": r"AIza[0-9A-Za-z_\-]{35}",
    "stripe": r"[sr]k_(?:live|test)_[0-9A-Za-z]{16,}", "jwt": r"eyJ[0-9A-Za-z_\-]{8,}\.[0-9A-Za-z_\-]{8,}\.[0-9A-Za-z_\-]{8,}", "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
}
FOR = {"key", "apikey", "api_key", "secret", "token", "password", "passwd", "pwd", "auth", "authorization", "bearer", "credential", "credentials", "access", "private", "client_secret", "access_token", "secret_key"}
AGAINST = {"sha", "sha1", "sha256", "md5", "hash", "checksum", "commit", "digest", "uuid", "guid", "id", "version", "build", "example", "sample", "placeholder", "dummy", "test", "fingerprint", "etag", "integrity", "revision", "url", "path", "file"}
PATH_AGAINST = ("test", "example", "sample", "fixture", "mock", "doc", "lock")
PATH_FOR = ("env", "config", "settings", "secret", "credential", "deploy")
WORDS = {"the", "and", "for", "with", "this", "that", "from", "have", "name", "user", "data", "file", "page", "http", "https", "www", "com", "org", "example", "test", "your", "here", "value", "change", "password", "secret", "token", "key", "long", "text", "word", "class", "function", "return", "index", "image", "content", "default", "config", "service", "server", "client", "request", "response", "string", "number", "version", "module", "package", "release", "update"}
PAIRS = {"th", "he", "in", "er", "an", "re", "on", "at", "en", "nd", "ti", "es", "or", "te", "of", "ed", "is", "it", "al", "ar", "st", "to", "nt", "ng", "se", "ha", "as", "ou", "io", "le", "ve", "co", "me", "de", "hi", "ri", "ro", "ic", "ne", "ea", "ra", "ce", "li", "ch", "ll", "be", "ma", "si", "om", "ur"}

_CANDIDATE = re.compile("|".join(f"(?P<{k}>{v})" for k, v in PREFIXES.items()) + r"|(?P<quoted>(?<=[\"'`])[0-9A-Za-z_\-+/=.!@#$%^&*]{12,}(?=[\"'`]))|(?P<run>(?<![0-9A-Za-z_\-+/=.@])(?=[A-Za-z_\-+/=]*[0-9])[0-9A-Za-z_\-+/=]{20,}(?![0-9A-Za-z_@]))")
_NEAR = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")
KINDS = [*PREFIXES, "quoted", "run"]
NAMES = [
    "length", "digits", "lower", "upper", "marks", "entropy", "changes", "pairs", "vowels", "repeats", "coverage", "hex", "uuid", "digits_only", "known", "quoted", "for", "against", "assigned", "path_for", "path_against",
]
_UUID = re.compile(r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")


def coverage(s: str) -> float:
    """Share of letters that frequent words of three letters or more cover, longest first from the left."""
    low, i, hit = s.lower(), 0, 0
    while i < len(low):
        n = next((n for n in (8, 7, 6, 5, 4, 3) if low[i : i + n] in WORDS and len(low[i : i + n]) == n), 0)
        hit, i = hit + n, i + max(n, 1)
    return hit / max(len(s), 1)


def features(s: str, kind: str, before: str, after: str, path: str | None) -> list[float]:
    n, low = len(s), s.lower()
    classes = [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in s]
    share = [classes.count(i) / n for i in range(4)]
    letters = [c for c in low if c.isalpha()]
    pairs = [a + b for a, b in zip(low, low[1:], strict=False) if a.isalpha() and b.isalpha()]
    near = [w.lower() for w in _NEAR.findall(before)[-4:] + _NEAR.findall(after)[:2]]
    parts = {p for w in near for p in (w, *w.split("_"))}
    path = (path or "").lower()
    return [
        math.log(n), *share, -sum(v / n * math.log2(v / n) for v in Counter(s).values()), sum(a != b for a, b in zip(classes, classes[1:], strict=False)) / n, sum(p in PAIRS for p in pairs) / max(len(pairs), 1),
        sum(c in "aeiou" for c in letters) / max(len(letters), 1), sum(a == b for a, b in zip(s, s[1:], strict=False)) / n, coverage(s), float(all(c in "0123456789abcdef" for c in low)), float(bool(_UUID.fullmatch(s))), float(s.isdigit()),
        float(kind in PREFIXES), float(kind == "quoted"), float(len(parts & FOR)), float(len(parts & AGAINST)), float(bool(re.search(r"[=:]\s*[\"'`]?$", before))),
        float(any(p in path for p in PATH_FOR)), float(any(p in path for p in PATH_AGAINST)),
    ]


def candidates(text: str | None, path: str | None):
    """(start, end, kind, features) of each candidate of a whole text; a word without a digit needs a quote around it."""
    for m in _CANDIDATE.finditer(text or ""):
        a, b = m.span()
        yield a, b, m.lastgroup, features(m.group(), m.lastgroup, text[max(0, a - 60) : a], text[b : b + 30], path)


def made_findings(n: int = 4000, seed: int = 3) -> list[tuple[str, str, str, str, str, int]]:
    """Labelled findings (string, kind, before, after, path, label) by a seeded rule: half secrets, half look-alikes."""
    r = random.Random(seed)
    hexa, base = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    some = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    prose = lambda k: " ".join(r.choice(sorted(WORDS)) for _ in range(k))
    out = []
    for i in range(n):
        label = i % 2
        quote, path = r.choice(["", '"', "'"]), r.choice(["src0", "src/app/config.py", ".env", "deploy/settings.yml", "lib/main.js", "README.md", ""])
        if label:
            s = r.choice([some(hexa, r.choice([32, 40, 64])), some(base, r.randint(20, 64)), some(base + "+/", r.choice([40, 44])) + r.choice(["", "=="]), some(base + "!@#$%", r.randint(14, 24)), "AKIA" + some(base[:26] + base[52:], 16), "ghp_" + some(base, 36), "sk_live_" + some(base, 24)])
            before = prose(r.randint(0, 4)) + r.choice(["\n", " "]) + r.choice(sorted(FOR)).replace("_", r.choice(["_", ""])) + r.choice([" = ", "=", ": ", " : "]) + quote
        else:
            word = lambda: r.choice(sorted(WORDS))
            s = r.choice([some(hexa, r.choice([32, 40, 64])), "-".join(some(hexa, k) for k in (8, 4, 4, 4, 12)), some("0123456789", r.randint(20, 24)), "-".join(word() for _ in range(4)) + "-" + some("0123456789", 3), "_".join(word() for _ in range(5)) + some("0123456789", 2), "x" * 20 + "1", "your_" + word() + "_token_here_1"])
            cue = r.choice(sorted(FOR)) if s.startswith(("x", "your")) else r.choice([*sorted(AGAINST), *sorted(WORDS - FOR)])
            before = prose(r.randint(0, 4)) + " " + cue + r.choice([" = ", ": ", " ", "/"]) + quote
            path = r.choice([path, "tests/fixtures.py", "package-lock.json", "docs/example.md"])
        m = _CANDIDATE.search(before[-1:] + s + quote) if quote else _CANDIDATE.search(" " + s)
        out.append((s, m.lastgroup if m else "run", before[-60:], quote + " " + prose(3), path, label))
    return out


def train(findings: DataFrame | None = None, max_findings: int = MAX_FINDINGS, seed: int = 3) -> Forest:
    """findings: (string, kind, before, after, path, label), the max_findings of smallest hash at most; None: made ones."""
    if findings is None:
        rows = made_findings(seed=seed)
    else:
        ordered = findings.where("string is not null and string <> '' and label is not null").orderBy(F.xxhash64("string", "before", "after"), "string", "before", "after", "label").limit(max_findings)
        rows = [tuple(r) for r in ordered.select("string", F.coalesce("kind", F.lit("run")), F.coalesce("before", F.lit("")), F.coalesce("after", F.lit("")), "path", "label").collect()]
    x = np.array([features(*r[:5]) for r in rows]).reshape(-1, len(NAMES))
    return forest(x, np.array([r[5] for r in rows], float), seed=seed)


def _scanned(model, threshold: float):
    def run(batches):
        for batch in batches:
            at: list[tuple] = []
            for doc_id, path, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                at += [(doc_id, path, a, b, kind, text[a:b], x) for a, b, kind, x in candidates(text, path)]
            scores = model.value.predict(np.array([r[6] for r in at]).reshape(-1, len(NAMES)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            cols = [pa.array([r[i] for r in at], t) for i, t in enumerate(kinds)] + [pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "path", "start", "end", "kind", "string", "score", "secret"])

    return run


def scan(docs: DataFrame, model: Forest, key: str = "doc_id", text: str = "text", path: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each candidate of each whole text: doc_id, path, start and end (characters), kind, string, score, secret.

    secret is 1 where the forest keeps the finding and 0 where it takes it for a false positive. Null and empty texts
    have none; null ids and paths are passed on; repeated rows are scanned each. A candidate may be as long as its text.
    Other columns, whatever their names, are not read.
    """
    ship(docs.sparkSession)
    read = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(path).cast("string").alias("path"), F.col(text).cast("string").alias("text"))
    return read.mapInArrow(_scanned(docs.sparkSession.sparkContext.broadcast(model), threshold), "doc_id bigint, path string, start bigint, end bigint, kind string, string string, score double, secret int")
