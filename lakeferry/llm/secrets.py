"""Secrets in texts: fixed patterns, and random strings that a token vocabulary splits too finely.

Base patterns find assignments, access keys and long hexadecimal runs. The method is a
token-efficiency test: a run of key characters that a public token vocabulary can only split into
very short tokens is no word of any language. A run that passes as a whole is tested once more in
parts, so that a path, a date or a base pattern beside a key doesn't hide it: the parts are what
slashes, UUIDs, dates and base spans leave of it. In a run without digits the unbroken stretches of
letters are tested: any word, even a compound of several or a made-up one, splits into longer tokens.
Known digests and identifiers (UUIDs, digest-labelled strings, dates, version paths, alphabets,
strings over few letters as of genes) are left out, and so is whatever a base pattern already holds.
Positions count code points, ends are exclusive.

Limits of the method: what is shorter than `LEAST_LENGTH` characters, or of digits only, is left to
the base patterns; of random strings of 20 lower-case letters a tenth splits as well as words do.

Defined results: a null or empty text has no spans; every row gets its own result, whatever its
id; an empty table gives an empty one. Other columns are never read.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.tiktoken"
# A run of at least so many characters is tested; fewer characters per token than this is random.
LEAST_LENGTH = 20
MOST_CHARS_PER_TOKEN = 1.9

KINDS = ("assign", "access", "hex", "random")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run, so the same as dropping shorter runs
RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST_LENGTH)
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
DIGEST_LABEL = re.compile(r"(md5|sha\d{1,3}(-\d{3})?)[:= -]\x20?$", re.IGNORECASE | re.ASCII)
DIGEST_LENGTHS = frozenset({32, 40, 56, 64, 96, 128})
LABELLED_LENGTHS = DIGEST_LENGTHS | {22, 24, 27, 28, 38, 43, 44, 86, 88}  # in hex or base64, which has slashes
WHOLE_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
DATED = re.compile(r"\d{4}-\d{2}-\d{2}|\d{8}T\d{6}")
SLASH = re.compile("/")
HAS_DIGIT, HAS_LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
WORDY = re.compile(r"[A-Za-z]{5,}")
LETTERS = re.compile(r"[A-Za-z]{%d,}" % LEAST_LENGTH)
FEW_LETTERS = 5  # as in genes
ALPHABETIC = 8  # letters in the order of the alphabet

FIELDS = "n_assign long, n_access long, n_hex long, n_random long, spans array<struct<kind:string,begin:int,end:int>>"
SPAN = pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())])
FOUND = pa.struct([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_random", pa.int64()), ("spans", pa.list_(SPAN))])

_encodings: dict[str, object] = {}


def _encoding(path: str):
    if path not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[path] = tiktoken.Encoding(
            "fertility", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _encodings[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(begin, end, kind's place) of the fixed patterns."""
    spans = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return spans


def known(run: str, before: str) -> bool:
    """Is it a digest or an identifier rather than a key?"""
    if UUID.search(run) or DATED.search(run) or DIGEST_LABEL.search(before):
        return True
    if WHOLE_HEX.fullmatch(run) and len(run) in DIGEST_LENGTHS:
        return True
    parts = re.split(r"[/_-]", run)  # paths and names made of words
    return sum(len(m) for p in parts for m in WORDY.findall(p) if p.isalpha()) * 2 > len(run)


def _parts(text: str, begin: int, end: int, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What slashes, UUIDs, dates and base spans leave of a run."""
    cuts = [(m.start(), m.end()) for p in (SLASH, UUID, DATED) for m in p.finditer(text, begin, end)]
    cuts += [(b, e) for b, e, _ in taken if b < end and begin < e]
    parts, at = [], begin
    for b, e in [*sorted(cuts), (end, end)]:
        if b - at >= LEAST_LENGTH:
            parts.append((at, b))
        at = max(at, e)
    return parts


def _alphabet(run: str) -> bool:
    """Is it a listing of letters in their order, or a string over few letters?"""
    low = run.lower()
    row = longest = 1
    for a, b in zip(low, low[1:], strict=False):
        row = row + 1 if ord(b) == ord(a) + 1 else 1
        longest = max(longest, row)
    return longest >= ALPHABETIC or len(set(low)) <= FEW_LETTERS


def _random_letters(text: str, begin: int, end: int, taken: list[tuple[int, int, int]], path: str) -> list[tuple[int, int, int]]:
    """Stretches of letters, in a run without digits, that the vocabulary splits into very short tokens."""
    spans = []
    for m in LETTERS.finditer(text, begin, end):
        b, e = m.span()
        if any(x < e and b < y for x, y, _ in taken) or DIGEST_LABEL.search(text[max(0, b - 12) : b]) or _alphabet(m[0]):
            continue
        if e - b < MOST_CHARS_PER_TOKEN * len(_encoding(path).encode_ordinary(m[0])):
            spans.append((b, e, 3))
    return spans


def _random(text: str, begin: int, end: int, path: str) -> bool:
    run = text[begin:end]
    if not (HAS_DIGIT.search(run) and HAS_LETTER.search(run)) or known(run, text[max(0, begin - 12) : begin]):
        return False
    return len(run) < MOST_CHARS_PER_TOKEN * len(_encoding(path).encode_ordinary(run))


def random_runs(text: str, taken: list[tuple[int, int, int]], path: str) -> list[tuple[int, int, int]]:
    """(begin, end, kind's place) of runs, or parts of them, that the vocabulary splits into very
    short tokens."""
    spans = []
    for m in RUN.finditer(text):
        begin, end = m.span()
        if not HAS_DIGIT.search(m[0]):
            spans += _random_letters(text, begin, end, taken, path)
            continue
        if not HAS_LETTER.search(m[0]):
            continue
        touched = any(b < end and begin < e for b, e, _ in taken)
        if not touched and _random(text, begin, end, path):
            spans.append((begin, end, 3))
        elif not (len(m[0]) in LABELLED_LENGTHS and DIGEST_LABEL.search(text[max(0, begin - 12) : begin])):
            spans += [(b, e, 3) for b, e in _parts(text, begin, end, taken) if (touched or (b, e) != (begin, end)) and _random(text, b, e, path)]
    return spans


def find(text: str, path: str) -> list[tuple[int, int, int]]:
    """All spans by begin, then kind."""
    base = base_spans(text)
    return sorted(base + random_runs(text, base, path), key=lambda s: (s[0], s[2], s[1]))


def spans_of(text: Column, path: str | None = None) -> Column:
    """A struct: the number of spans of each kind, and the spans."""
    path = path or vocabulary_path()

    def found(column: pa.Array) -> pa.Array:
        rows = []
        for value in column:
            spans = find(value.as_py() or "", path)
            counts = [sum(s[2] == k for s in spans) for k in range(4)]
            rows.append(
                dict(zip(("n_assign", "n_access", "n_hex", "n_random"), counts, strict=True))
                | {"spans": [{"kind": KINDS[k], "begin": b, "end": e} for b, e, k in spans]}
            )
        return pa.array(rows, FOUND)

    found.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(found, FIELDS)(text)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, counts by kind, spans) for every row."""
    return docs.select(F.col(id_col), spans_of(F.col(text_col), **how).alias("found")).select(id_col, "found.*")


def listed(spans: Column) -> Column:
    """kind:begin:end of each span, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(text: str, path: str, mark: str) -> str:
    """The text with every span replaced by a mark; spans that overlap or touch become one."""
    out, at, until = [], 0, -1
    for begin, end, _ in find(text, path):
        if begin > until:
            out += [text[at:begin], mark]
        until = max(until, end)
        at = until
    return "".join([*out, text[at:]])


def redacted(text: Column, path: str | None = None, mark: str = "[SECRET]") -> Column:
    """The text without its secrets; null stays null."""
    path = path or vocabulary_path()

    def clean(column: pa.Array) -> pa.Array:
        return pa.array((None if v is None else redact(v, path, mark) for v in (x.as_py() for x in column)), pa.string())

    clean.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(clean, "string")(text)


def digest(spans: Column) -> Column:
    """SHA-256 of the listed spans of the base kinds."""
    return F.sha2(listed(F.filter(spans, lambda s: s["kind"] != "random")).cast("binary"), 256)

