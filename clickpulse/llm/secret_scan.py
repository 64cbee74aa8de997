"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

A byte-pair vocabulary writes natural words in few tokens and random strings
in many.  Long runs of key characters that hold a letter are tokenized; where
a token covers fewer than ``MAX_CHARS_PER_TOKEN`` characters on average, the
run is random.  As words glued to a key raise that average, the pieces of a
run between its separators are tested as well, the long ones first.  Letters
of one case have ``ONE_CASE`` of the limit, as rare words in capitals come
near it; without a digit, separators do not count.  Runs of fewer than
``LONG_RUN`` characters need a digit and a lower ratio.  Digests of usual lengths, UUIDs, dates, numbers, alphabets,
patterns of few letters, and paths, versions and names made of short plain
pieces are not secrets and left out.  What touches a span of
the fixed patterns is theirs already.

Every row is handled alone, so nothing is shuffled.  Cases: a null or empty
text has no span; bytes that are no UTF-8 count as U+FFFD; equal spans of different kinds are all reported; repeated
rows are scanned one by one; an empty table gives no rows; other columns pass
through ``redact`` untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.llm.common import map_arrow, slices, texts_of

KINDS = ("assign", "access", "hex", "random")
MAX_CHARS_PER_TOKEN = 2.0
ONE_CASE = 0.95
MIN_RANDOM = 16
#: Runs of fewer characters hold a digit and have ``SHORT`` of the limit.
LONG_RUN, SHORT = 20, 0.8
#: A random string without digits has more different letters, and words of
#: more letters between its separators.
MIN_LETTERS = 8
MASK = "[secret]"

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that are long enough
_RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_RANDOM},}}")
_LETTER, _DIGIT, _WORDS = re.compile(r"[A-Za-z]"), re.compile(r"[0-9]"), re.compile(r"[A-Za-z]+")
#: The pieces of a run between its separators, the long ones first.
_PIECES = [re.compile(rf"[A-Za-z0-9+{inner}]{{{MIN_RANDOM},}}") for inner in ("_-", "/=", "")]
#: Digests (64-bit ones, MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512 in either case),
#: UUIDs, numbers with a short prefix (ISBN-978-3-16-148410-0), and times.
_KNOWN = re.compile(
    r"(?:[0-9a-f]{16}|[0-9A-F]{16}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}"
    r"|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{56}|[0-9A-F]{64}|[0-9A-F]{96}|[0-9A-F]{128}"
    r"|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"
    r"|[A-Za-z]{0,8}[-_=]?[0-9]+(?:[-_/][0-9]+)*"
    r"|\d{4}-\d\d-\d\dT[0-9]*Z?)")
#: Paths, versions, names of systems and punycode: short pieces, each of
#: letters, of digits, or of letters with a number behind or before them.
_PIECE = r"(?:[A-Za-z]{1,15}|[0-9]{1,8}|[A-Za-z]{1,12}[0-9]{1,4}|[0-9]{1,4}[A-Za-z]{1,4}|[a-z]{1,4}[0-9]{1,2}[a-z]{1,2})"
_NAMED = re.compile(rf"(?:xn--[a-z0-9]{{1,20}}|[/_=+-]*{_PIECE})(?:[/_=+-]+{_PIECE}){{2,}}[/_=+-]*")

_encodings: dict = {}


def _encoding(path: str, pattern: str):
    if path not in _encodings:
        import base64
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the fixed patterns, in that order."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def listed_letters(run: str) -> bool:
    """Letters that mostly follow each other in the alphabet, or few of them."""
    steps = sum(b == a + 1 for a, b in zip(run.encode(), run.encode()[1:]))
    return len(set(run)) < MIN_LETTERS or 2 * steps >= len(run) - 1


def is_random(run: str, encoding, max_ratio: float) -> bool:
    if not _LETTER.search(run) or _KNOWN.fullmatch(run) or _NAMED.fullmatch(run):
        return False
    if len(run) < LONG_RUN:
        return bool(_DIGIT.search(run)) and len(run) < SHORT * max_ratio * len(encoding.encode_ordinary(run))
    if _DIGIT.search(run):
        return len(run) < max_ratio * len(encoding.encode_ordinary(run))
    # separators between short words cost tokens, so only the letters count
    words = _WORDS.findall(run)
    letters = "".join(words)
    if len(letters) < MIN_LETTERS * len(words) or listed_letters(letters):
        return False
    if letters.islower() or letters.isupper():
        max_ratio *= ONE_CASE
    return len(letters) < max_ratio * sum(len(encoding.encode_ordinary(w)) for w in words)


def random_spans(text: str, base: list[tuple[int, int, int]], encoding, max_ratio: float) -> list[tuple[int, int, int]]:
    """Runs, and pieces of runs, that the vocabulary covers badly and no base
    span touches; of overlapping ones the first tested."""
    out = []
    for m in _RUN.finditer(text):
        if _KNOWN.fullmatch(m[0]):
            continue
        taken = [(a, b) for a, _, b in base if a < m.end() and m.start() < b]
        for a, b in _candidates(m):
            if any(c < b and a < d for c, d in taken):
                continue
            if is_random(text[a:b], encoding, max_ratio):
                taken.append((a, b))
                out.append((a, 3, b))
    return sorted(out)


def _candidates(run: re.Match) -> dict[tuple[int, int], None]:
    found = {run.span(): None}
    for pieces in _PIECES:
        for m in pieces.finditer(run.string, *run.span()):
            found[m.span()] = None
    return found


def _listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame, vocabulary: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
                 max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, n_random and spans
    (kind:start:end in code points, by start, then kind)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex")],
                           T.StructField("base_sha256", T.StringType()), T.StructField("n_random", T.LongType()),
                           T.StructField("spans", T.StringType())])

    def run(batches):
        enc = _encoding(vocabulary, pattern)
        for b in slices(batches):
            cols: list[list] = [[] for _ in range(6)]
            for text in texts_of(b.column(1)):
                base = base_spans(text or "")
                more = random_spans(text or "", base, enc, max_chars_per_token)
                n = [sum(s[1] == k for s in base) for k in range(3)]
                sha = hashlib.sha256(_listed(base).encode()).hexdigest()
                for c, v in zip(cols, (*n, sha, len(more), _listed(sorted(base + more)))):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.string() if i in (3, 5) else pa.int64()) for i, c in enumerate(cols))],
                schema.names)

    return map_arrow(rows, run, schema)


def masked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    out, done = [], 0
    for a, _, b in sorted(spans):
        if a >= done:
            out.append(text[done:a] + mask)
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, vocabulary: str, pattern: str, *, text_col: str = "text", mask: str = MASK,
           max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """``docs`` with every span replaced by ``mask``; documents all stay, and
    a column n_chars follows the new text."""
    names, schema, at = docs.columns, docs.schema, docs.columns.index(text_col)

    def run(batches):
        enc = _encoding(vocabulary, pattern)
        for b in slices(batches):
            texts = texts_of(b.column(at))
            for i, text in enumerate(texts):
                if text:
                    base = base_spans(text)
                    spans = base + random_spans(text, base, enc, max_chars_per_token)
                    if spans:
                        texts[i] = masked(text, spans, mask)
            yield pa.RecordBatch.from_arrays([pa.array(texts, b.schema.field(i).type) if i == at else b.column(i)
                                              for i in range(len(names))], names)

    out = map_arrow(docs, run, schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length(text_col).cast(schema["n_chars"].dataType))
    return out
