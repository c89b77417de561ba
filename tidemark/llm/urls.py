"""URL filter: host and path rules first, else a logistic regression on hashed character n-grams.

The regression learns from a small labelled URL table (``LABELLED``, or one of the caller's) and
scores each URL on its own, so the filter is one pass without a shuffle.

Rows: a NULL URL, or one without ``://``, has an empty host and path, fits no rule and gets the
verdict of the model's intercept. Repeated rows are judged alike. An empty table gives an empty
result. Columns of the input other than the URL are carried along; ``host``, ``path``, ``rule``,
``score`` and ``verdict`` of the input give way to those of the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIMENSIONS, LENGTHS = 1 << 14, (3, 4, 5)
HOST_AND_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: Labelled URLs: hosts and paths of wanted and unwanted sites.
LABELLED: dict[str, Sequence[str]] = {
    BLOCK: (
        "http://casino-win.test/en/12", "https://www.casino-royal-win.test/fr/4.html", "http://best-casino.test/slots/7",
        "https://play-casino-online.test/bonus/", "http://free-bets.test/en/991", "https://m.free-bets-today.test/de/3",
        "http://sport-bets.test/odds/12", "https://betting-win.test/en/55/", "http://poker-bets.test/free/",
        "https://spam-farm.test/en/728", "http://www.spam-links-farm.test/es/18802", "https://link-farm.test/seo/1",
        "http://spam-mail.test/offers/3", "https://blog.spam-farm-net.test/de/10", "http://cheap-pills.test/fr/17",
        "https://blog.cheap-pills-shop.test/en/9", "http://buy-pills.test/order/2", "https://cheap-meds.test/viagra/",
        "http://online-pills-pharmacy.test/es/6", "https://adult-x.test/en/4", "http://www.adult-x-video.test/free/",
        "https://xxx-adult.test/de/21", "http://adult-chat.test/cam/8", "https://ads-track.test/en/6",
        "http://m.ads-track-click.test/fr/44", "https://track-ads.test/pixel/1", "http://ads-click.test/redirect/9",
        "https://popup-ads.test/banner/", "http://win-free-money.test/claim/3", "https://cheap-loans.test/apply/2",
        "http://free-win-prize.test/en/5", "https://www.casino-win.test/es/70", "http://cheap-watches-replica.test/buy/",
        "https://ads-track.test/de/100", "http://adult-x.test/fr/33", "https://free-bets.test/es/8#top",
        "http://spam-farm.test/fr/9?page=2", "https://cheap-pills.test/de/12/", "http://casino-win.test/de/90.html",
    ),
    ALLOW: (
        "https://www.library.test/en/12", "http://blog.garden-notes.test/fr/4.html", "https://university.test/research/7",
        "http://museum.test/collection/", "https://m.weather.test/en/991", "http://thether.test/de/3", "https://tionth.test/en/685",
        "http://blog.thonth.test/en/55/", "https://www.therand.test/fr/17", "http://m.thinst.test/es/18802", "https://thenre.test/de/1",
        "http://history-of-art.test/essay/3", "https://blog.tionsh.test/de/10", "http://news.test/world/2026/1", "https://recipes.test/bread/9",
        "http://www.science-daily.test/article/2", "https://code-docs.test/guide/", "http://open-street.test/es/6", "https://thstre.test/en/4",
        "http://m.thwhat.test/en/8", "https://poetry.test/de/21", "http://www.health-service.test/advice/8", "https://city-council.test/en/6",
        "http://blog.tiered.test/fr/44", "https://theater.test/program/1", "http://mathematics.test/lecture/9", "https://bird-watch.test/guide/",
        "http://encyclopedia.test/wiki/3", "https://school.test/timetable/2", "http://thatand.test/en/5", "https://www.thores.test/es/70",
        "http://chess-club.test/games/", "https://thing.test/de/100", "http://ththly.test/fr/33", "https://tioner.test/es/8#top",
        "http://river-trust.test/fr/9?page=2", "https://linguistics.test/de/12/", "http://astronomy.test/de/90.html", "https://m.thinger.test/en/44",
        "https://www.thouth.test/en/4#top", "http://blog.ththre.test/en/310?ref=x", "https://farm-school.test/en/2", "http://railway-track-guide.test/en/7",
    ),
}


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    intercept: float


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (ASCII-lower-cased) and path; both empty for NULL and where ``://`` is missing."""
    found = lambda group: F.coalesce(F.regexp_extract(url, HOST_AND_PATH, group), F.lit(""))
    return F.translate(found(1), UPPER, LOWER), found(2)


def first_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; of equally long ones the first listed."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # what is asked later takes precedence
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def grams_of(host: str, path: str) -> np.ndarray:
    """Hashed n-grams of the host and of the path, told apart by a mark; each counts once."""
    found = set()
    for mark, text in ((b"h", f"^{host}$"), (b"p", f"^{path}$")):
        raw = text.encode("utf-8", "surrogatepass")
        for n in LENGTHS:
            found.update(zlib.crc32(mark + raw[k : k + n]) % DIMENSIONS for k in range(len(raw) - n + 1))
    return np.fromiter(found, np.int64, len(found))


def plain_split(url: str | None) -> tuple[str, str]:
    """``split_url`` for one string."""
    _, mark, rest = (url or "").partition("://")
    cut = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[cut:]
    stop = next((k for k, c in enumerate(path) if c in "?#"), len(path))
    return (rest[:cut].translate(str.maketrans(UPPER, LOWER)), path[:stop]) if mark else ("", "")


def train(labelled: dict[str, Sequence[str]] = LABELLED, epochs: int = 300, rate: float = 1.0, decay: float = 1e-3) -> Model:
    """Batch gradient descent on a small table; the result does not depend on the row order."""
    rows = [(grams_of(*plain_split(u)), float(label == BLOCK)) for label, urls in labelled.items() for u in urls]
    x = np.zeros((len(rows), DIMENSIONS))
    for k, (grams, _) in enumerate(rows):
        x[k, grams] = 1 / np.sqrt(max(1, len(grams)))
    y = np.array([label for _, label in rows])
    w, b = np.zeros(DIMENSIONS), 0.0
    for _ in range(epochs):
        error = 1 / (1 + np.exp(-(x @ w + b))) - y
        w -= rate * (x.T @ error / len(y) * 20 + decay * w)
        b -= rate * error.mean()
    return Model(w, b)


def score(host: str, path: str, model: Model) -> float:
    grams = grams_of(host, path)
    z = model.weights[grams].sum() / np.sqrt(max(1, len(grams))) + model.intercept
    return float(1 / (1 + np.exp(-z)))


def judged(pages: DataFrame, rules: Sequence[Rule], model: Model | None = None, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` (of being unwanted) and ``verdict``."""
    net = model or train()

    @F.pandas_udf("double")
    def unwanted(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([score(h, p, net) for h, p in zip(hosts, paths, strict=True)], dtype="float64")

    host, path = split_url(F.col(url_col).cast("string"))
    kept = [F.col(c) for c in pages.columns if c == url_col or c not in ("host", "path", "rule", "score", "verdict")]
    parts = pages.select(*kept, host.alias("host"), path.alias("path"))
    name, verdict = first_rule(F.col("host"), F.col("path"), rules)
    scored = parts.withColumn("rule", name).withColumn("score", unwanted("host", "path"))
    judged_by_model = F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW)
    return scored.withColumn("verdict", F.coalesce(verdict, judged_by_model))
