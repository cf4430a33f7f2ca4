"""URL filters: listed rules first, then a logistic regression on hashed character n-grams.

A rule names a host and a path; it fits that host and its subdomains if the URL's path starts with
its path, and the longest fitting rule decides. A URL that no rule fits is judged by a logistic
regression on the character n-grams of its host and of its path, hashed into a fixed number of
weights, which is trained from a small table of labelled URLs. The weights have a fixed size and
go to the tasks with the function; the rules are a parameter of the caller, of at most
`MOST_RULES` rows.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and
gets the model's verdict for nothing, which is to allow; rows are judged one by one, whatever their
ids; an empty table gives an empty one. Only the id and the URL are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEIGHTS = 1 << 16
GRAMS = (3, 4, 5)
MOST_RULES = 1_000_000
MOST_LABELS = 100_000
ROUNDS = 300

RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

# The labelled table: words that hosts and paths of unwanted and of ordinary pages are made of, as URLs.
_UNWANTED = (
    "casino", "casino-royal", "online-casino", "win-casino", "poker-bets", "bets", "free-bets", "sport-bets",
    "bet-win", "lottery-win", "slots-win", "adult", "adult-video", "adult-chat", "xxx-adult", "x-rated", "porn-tube",
    "sex-cam", "cheap-pills", "pills", "pills-shop", "cheap-meds", "viagra-cheap", "spam", "spam-mail", "link-farm",
    "spam-farm", "content-farm", "ads", "ads-server", "ad-track", "track-click", "click-ads", "pixel-track",
    "popup-ads", "free-iphone", "free-money", "cheap-loans", "win-prize", "malware-drop", "phish-login",
)
_ORDINARY = (
    "library", "city-museum", "weather", "daily-news", "university", "physics", "cooking", "garden", "history-notes",
    "travel", "open-source", "wiki", "health", "school", "music", "theatre", "football", "gazette", "science-review",
    "railways", "mathematics", "writers", "recipes", "mountains", "photography", "handbook", "archive", "parliament",
    "thinking", "nationwide", "theory", "anderson", "stone", "eastern", "whether", "tribune", "thread", "heritage",
    "reading", "ontario", "houses",
)
_FORMS = (
    "https://{}.example.com/en/1204.html", "http://www.{}.example.org/de/77?page=2", "https://blog.{}.example.net/fr/31000/",
    "https://m.{}.example.com/es/505#top", "https://{}.org/about", "http://{}.com/",
)
# The same words as paths of hosts that say nothing: here only the path decides.
_PATH_FORMS = (
    "http://files.harbor-hosting.example/{}", "https://members.lumen.example/~kim/{}/", "http://www.pinecone.test/area/{}/index.php",
    "https://static.quayside.example/u/418/{}.htm", "http://board.millrace.test/thread/{}/latest", "https://orbit.invalid/stuff/{}/gallery",
)
# Paths that say nothing either; such pages are ordinary.
_PLAIN = ("about", "contact", "help", "a/b", "main", "files", "2", "terms", "team", "faq", "list", "print")
LABELED = tuple(
    (form.format(w), bad)
    for words, bad, forms in (
        (_UNWANTED, 1, (*_FORMS, *_PATH_FORMS)), (_ORDINARY, 0, (*_FORMS, *_PATH_FORMS)), (_PLAIN, 0, _PATH_FORMS),
    )
    for w in words for form in forms
)

PARTS = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
FIELDS = "host string, path string, rule string, verdict string, score double"


def parts(url: str | None) -> tuple[str, str]:
    """(host in lower case, path) of a URL."""
    found = PARTS.search(url or "")
    if not found:
        return "", ""
    host = found[1].translate({c: c + 32 for c in range(65, 91)})
    return host, found[2]


def grams(host: str, path: str) -> np.ndarray:
    """The places of the weights of a URL's n-grams."""
    out = set()
    for mark, text in ((b"h", host), (b"p", path)):
        raw = b"^" + text.encode("utf-8", "replace") + b"$"
        for n in GRAMS:
            out.update(zlib.crc32(mark + raw[i : i + n]) % WEIGHTS for i in range(len(raw) - n + 1))
    return np.fromiter(sorted(out), np.int64, len(out))


def train(labeled: Iterable[tuple[str, int]], rounds: int = ROUNDS, rate: float = 4.0, decay: float = 1e-4) -> np.ndarray:
    """Weights, the last one constant, by gradient descent on a bounded table of (url, blocked)."""
    rows = list(labeled)
    if len(rows) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labelled URLs")
    weights = np.zeros(WEIGHTS + 1)
    if not rows:
        return weights
    found = [grams(*parts(url)) for url, _ in rows]
    label = np.array([y for _, y in rows], float)
    lengths = np.array([len(f) for f in found])
    flat, row = np.concatenate(found), np.repeat(np.arange(len(rows)), lengths)
    scale = (1 / np.sqrt(np.maximum(lengths, 1)))[row]
    for _ in range(rounds):
        z = np.bincount(row, weights[flat] * scale, len(rows)) + weights[-1]
        wrong = (1 / (1 + np.exp(-z)) - label) / len(rows)
        weights[:-1] -= rate * (np.bincount(flat, wrong[row] * scale, WEIGHTS) + decay * weights[:-1])
        weights[-1] -= rate * wrong.sum()
    return weights


@lru_cache(maxsize=1)
def trained() -> np.ndarray:
    return train(LABELED)


def score(weights: np.ndarray, host: str, path: str) -> float:
    """How likely the URL is to be blocked; nothing to judge is not."""
    if not host and not path:
        return 0.0
    places = grams(host, path)
    z = weights[places].sum() / np.sqrt(max(len(places), 1)) + weights[-1]
    return float(1 / (1 + np.exp(-z)))


def fitting(rules: dict[str, list[tuple[str, str]]], host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule that fits; of equal ones the first in text order."""
    best = None
    at = 0
    while at >= 0 and host:
        suffix = host[at:]
        for start, verdict in rules.get(suffix, ()):
            if path.startswith(start):
                key = (-len(suffix) - len(start), suffix + start, verdict)
                best = key if best is None or key < best else best
        at = host.find(".", at) + 1 or -1
    return best and best[1:]


def verdict(url: Column, rules=RULES, weights: np.ndarray | None = None, threshold: float = 0.5) -> Column:
    """A struct: host, path, the rule that fits, the verdict, and the model's score."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    weights = trained() if weights is None else weights
    listed: dict[str, list[tuple[str, str]]] = {}
    for host, path, decided in rules:
        listed.setdefault(host, []).append((path, decided))
    kinds = pa.struct([("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("score", pa.float64())])

    def judged(column: pa.Array) -> pa.Array:
        rows = []
        for value in column:
            host, path = parts(value.as_py())
            rule = fitting(listed, host, path)
            found = score(weights, host, path)
            rows.append((host, path, rule and rule[0], rule[1] if rule else "block" if found >= threshold else "allow", found))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], fields=list(kinds))

    judged.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(judged, FIELDS)(url)


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", **how) -> DataFrame:
    """(id, host, path, rule, verdict, score) for every row."""
    found = pages.select(F.col(id_col), verdict(F.col(url_col), **how).alias("found"))
    return found.select(id_col, "found.*")
