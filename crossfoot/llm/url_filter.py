"""URL filter: host and path rules, and logistic regression on hashed character n-grams for the rest.

The model is trained on a small labelled table (``LABELLED``) in plain Python: its size never depends on the data. Its
weights are whole numbers, so a score is an exact sum on any engine. Scoring is a column expression.

Defined results: a NULL url or one without ``://`` has an empty host and path and gets the model's verdict for an empty
url (allow, as most urls are). Repeated rows stay repeated, further columns of the input are not used, an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
GRAM_SIZES = (3, 4, 5)
WEIGHT_UNIT = 1_000_000
#: Scores up to this one, with log-odds of 0.2, still allow: without a telling n-gram a url is let through.
BLOCK_ABOVE = 200_000

# The rules, as (host, path start, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

# Invented hosts and paths with the verdict a person would give them; 1 is block.
LABELLED = (
    ("adult-clips.example.com", "/watch/1", 1), ("www.adult-live.example.org", "/en/20", 1), ("adultcams.example.com", "/", 1),
    ("xxx-videos.example.org", "/xxx/3.html", 1), ("free-porn.example.com", "/de/11", 1), ("hot-sex-chat.example.org", "/join", 1),
    ("casino-royal.example.com", "/play", 1), ("www.online-casino.example.org", "/en/bonus", 1), ("mega-casino-win.example.com", "/slots", 1),
    ("lucky-slots.example.org", "/spin/4", 1), ("poker-bonus.example.com", "/fr/6.html", 1), ("free-bets-now.example.com", "/odds", 1),
    ("sport-bets.example.org", "/en/33", 1), ("best-betting.example.com", "/tips", 1), ("jackpot-win.example.org", "/es/2", 1),
    ("cheap-pills.example.com", "/buy", 1), ("www.cheap-meds.example.org", "/viagra", 1), ("pills-online.example.com", "/cialis/9", 1),
    ("diet-pills.example.org", "/en/order.html", 1), ("spam-mailer.example.com", "/send", 1), ("link-farm.example.org", "/page/7", 1),
    ("seo-spam-links.example.com", "/de/4", 1), ("ads-server.example.com", "/click", 1), ("ad-track.example.org", "/pixel.gif", 1),
    ("track-ads.example.com", "/banner/5", 1), ("popup-ads.example.org", "/en/8", 1), ("fake-watches.example.com", "/replica", 1),
    ("replica-bags.example.org", "/sale", 1), ("warez-crack.example.com", "/keygen.exe", 1), ("free-cracks.example.org", "/download", 1),
    ("torrent-hub.example.com", "/get/1", 1), ("phish-login.example.org", "/verify-account", 1), ("malware-drop.example.com", "/setup.exe", 1),
    ("payday-loans.example.org", "/apply", 1), ("get-rich-quick.example.com", "/crypto-double", 1), ("escort-girls.example.org", "/city", 1),
    ("news.example.com", "/en/2041.html", 0), ("www.daily-herald.example.org", "/de/117", 0), ("blog.gardening.example.com", "/fr/31.html", 0),
    ("m.weather.example.org", "/en/5/", 0), ("wiki.history.example.com", "/es/88", 0), ("library.example.org", "/fr/1203/", 0),
    ("www.university.example.com", "/courses/12", 0), ("docs.software.example.org", "/en/guide.html", 0), ("blog.cooking.example.com", "/de/440.html", 0),
    ("recipes.example.org", "/es/17/", 0), ("m.travel.example.com", "/fr/9001", 0), ("museum.example.org", "/en/6", 0),
    ("www.city-council.example.com", "/de/73/", 0), ("science-journal.example.org", "/en/310.html", 0), ("music.example.com", "/fr/22", 0),
    ("www.theatre.example.org", "/es/64.html", 0), ("forum.linux.example.com", "/en/771", 0), ("photos.example.org", "/de/5/", 0),
    ("school.example.com", "/en/19", 0), ("blog.books.example.org", "/fr/404.html", 0), ("hiking-trails.example.com", "/en/7/", 0),
    ("m.radio.example.org", "/de/2.html", 0), ("www.bridge-club.example.com", "/en/98", 0), ("physics.example.org", "/fr/13/", 0),
    ("astronomy.example.com", "/es/1001", 0), ("www.railways.example.org", "/de/350.html", 0), ("blog.knitting.example.com", "/en/42/", 0),
    ("maps.example.org", "/en/86", 0), ("garden-center.example.com", "/fr/55.html", 0), ("m.football.example.org", "/es/3/", 0),
    ("www.hospital.example.com", "/de/61", 0), ("court-records.example.org", "/en/9.html", 0), ("chess.example.com", "/fr/24/", 0),
    ("www.transport.example.org", "/en/508", 0), ("blog.economy.example.com", "/es/7.html", 0), ("parliament.example.org", "/de/12/", 0),
    ("m.thornton.example.com", "/en/30", 0), ("blog.northern.example.org", "/fr/2900.html", 0), ("theory.example.com", "/en/15/", 0),
    ("www.nation.example.org", "/de/81", 0), ("weathering.example.com", "/en/700", 0), ("m.either.example.org", "/es/46/", 0),
    ("blog.therapy-advice.example.com", "/en/3.html", 0), ("www.thrushes.example.org", "/fr/18", 0), ("ornithology.example.com", "/de/27/", 0),
)


def _bucket(gram: str) -> int:
    return int(hashlib.md5(gram.encode()).hexdigest()[:3], 16) % BUCKETS


def _grams(mark: str, text: str) -> list[str]:
    return [f"{mark}{text[i : i + n]}" for n in GRAM_SIZES for i in range(len(text) - n + 1)]


@dataclass(frozen=True)
class UrlModel:
    """Whole-number weights per bucket and a bias; a url is blocked when the sum is above ``BLOCK_ABOVE``."""

    weights: tuple[int, ...]
    bias: int


@lru_cache(maxsize=4)
def train(labelled: tuple[tuple[str, str, int], ...] = LABELLED, rounds: int = 400, rate: float = 0.05, penalty: float = 0.002) -> UrlModel:
    """Batch gradient descent on the logistic loss with an L2 penalty; counts of n-grams are the features."""
    rows = []
    for host, path, label in labelled:
        counts: dict[int, int] = {}
        for gram in _grams("h", host) + _grams("p", path):
            counts[_bucket(gram)] = counts.get(_bucket(gram), 0) + 1
        rows.append((counts, label))
    weights, bias = [0.0] * BUCKETS, 0.0
    for _ in range(rounds):
        slope, shift = dict.fromkeys({b for counts, _ in rows for b in counts}, 0.0), 0.0
        for counts, label in rows:
            score = bias + sum(weights[b] * n for b, n in counts.items())
            miss = 1 / (1 + math.exp(-max(-30.0, min(30.0, score)))) - label
            shift += miss / len(rows)
            for b, n in counts.items():
                slope[b] += miss * n / len(rows)
        bias -= rate * shift
        for b, g in slope.items():
            weights[b] -= rate * (g + penalty * weights[b])
    return UrlModel(tuple(round(w * WEIGHT_UNIT) for w in weights), round(bias * WEIGHT_UNIT))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url as column expressions."""
    start = F.instr(url, "://")
    after = F.when(start > 0, F.substr(url, start + F.lit(3))).otherwise(F.lit(""))
    raw = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(after, F.length(raw) + F.lit(1)), r"^[^?#]*", 0)
    lowered = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both NULL when none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, said in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):  # the longest is tested first
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        text, verdict = F.when(fits, F.lit(name + start)).otherwise(text), F.when(fits, F.lit(said)).otherwise(verdict)
    return text, verdict


def model_score(host: str, path: str, model: UrlModel) -> Column:
    """Sum of the weights of all n-grams of the columns ``host`` and ``path``, as a whole number."""
    table = f"cast(split('{','.join(map(str, model.weights))}', ',') as array<bigint>)"

    def part(mark: str, column: str, n: int) -> str:
        places = f"if(length({column}) >= {n}, sequence(1, length({column}) - {n - 1}), array())"
        bucket = f"cast(conv(substr(md5(concat('{mark}', substr({column}, i, {n}))), 1, 3), 16, 10) as int) % {BUCKETS}"
        return f"aggregate({places}, 0L, (total, i) -> total + element_at({table}, {bucket} + 1))"

    parts = [part(mark, column, n) for mark, column in (("h", host), ("p", path)) for n in GRAM_SIZES]
    return F.expr(f"{model.bias}L + " + " + ".join(parts))


def judge_urls(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    rules: tuple[tuple[str, str, str], ...] = RULES,
    model: UrlModel | None = None,
) -> DataFrame:
    """One row per page: id, host, path, rule, model score and verdict (the rule's, else the model's)."""
    model = model or train()
    host, path = split_url(pages[url_column])
    parted = pages.select(pages[id_column].alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(parted["host"], parted["path"], rules)
    scored = parted.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("said"), model_score("host", "path", model).alias("model_score"))
    by_model = F.when(F.col("model_score") > BLOCK_ABOVE, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", "model_score", F.coalesce("said", by_model).alias("verdict"))
