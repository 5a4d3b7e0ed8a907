"""URL filters: allow and block rules first, and for all other URLs a logistic regression on hashed character n-grams of
host and path, trained from a small labelled table."""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only, small_batches, values

BITS = 15
GRAMS = (3, 4, 5)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def labelled(seed: int = 17) -> list[tuple[str, str, int]]:
    """(host, path, 1 for block), about 4,500 rows made by rule from general vocabulary: names of gambling, adult, pill, loan,
    piracy and phishing sites against names of ordinary ones, in several forms, under several endings and paths. Hosts of
    random letters, as programs make them, are to be blocked; made-up names that can be spoken, parts of words run together
    and short initials are ordinary."""
    r = random.Random(seed)
    bad = (
        "casino poker slots roulette blackjack betting jackpot sportsbook gambling lotto bingo wager payout xxx porn adult sex nude escort hookup webcam milf erotic camgirls singles "
        "viagra cialis pharmacy pills steroid tramadol xanax weightloss payday loans credit debt forex crypto bonus cash earnmoney getrich doubling giveaway prizes winner freegift "
        "crack keygen warez torrent serial nulled cheats hacks spyware malware phishing verify-account secure-login password-reset replica rolex fakebags clickbait traffic backlinks spam"
    ).split()
    good = (
        "library university school college museum theatre gallery archive encyclopedia dictionary journal research science physics chemistry biology history geography language news times post tribune "
        "gazette weather climate forecast health hospital clinic dental garden kitchen recipes cooking travel hotel railway airline maps transit city council government ministry parliament court law "
        "software python linux docs wiki developer database cloud forum community blog photos music books publishing furniture bicycle football running yoga charity church family kids toys market bakery"
    ).split()
    ends = (".com", ".net", ".org", ".info", ".co.uk", ".de", ".fr", ".io", ".biz", ".eu")
    subs = ("", "", "www.", "m.", "blog.", "shop.", "en.")
    plain = ("", "/", "/index.html", "/about", "/contact.php", "/article/{n}", "/{y}/{m}/story", "/news/{n}.html", "/category/page-{n}", "/products/{n}", "/user/profile", "/search", "/help/faq", "/en/{n}", "/fr/{n}/", "/de/{n}.html", "/es/page/{n}")
    bait = ("/free-{w}", "/win/{w}", "/{w}/bonus", "/download/{w}.exe", "/click/{n}", "/signup-now", "/{w}-online", "/best-{w}", "/deals/{w}")
    add = ("best", "top", "online", "free", "my", "the", "club", "world", "zone", "hub", "24", "365", "live", "pro")
    path = lambda kinds, w: r.choice(kinds).format(n=r.randint(1, 99999), y=r.randint(1998, 2030), m=r.randint(1, 12), w=w)
    out = []
    for words, label in ((bad, 1), (good, 0)):
        for w in words:
            for form in (*range(10), *(range(10) if label else ())):
                other = r.choice(words)
                name = (w, f"{w}{other}", f"{w}-{other}", f"{r.choice(add)}{w}", f"{w}{r.choice(add)}", f"{r.choice(add)}-{w}", f"{w}{r.randint(1, 999)}", f"{w}s", f"{other}.{w}", f"{r.choice(add)}{w}-{other}")[form]
                out.append((f"{r.choice(subs)}{name}{r.choice(ends if label else (*ends, '.gov', '.edu', '.ac.uk'))}", path((*plain * 2, *bait) if label else plain, w), label))
    for i in range(600):
        spoken = "".join(r.choice("bcdfghklmnprstvwz") + r.choice("aeiou") + r.choice(("", "", "n", "r", "s", "l", "th")) for _ in range(r.randint(2, 4)))
        out.append((f"{r.choice(subs)}{spoken}{r.choice(ends)}", path(plain, spoken), 0))
        if i % 2:
            letters = "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(r.randint(12, 24)))
            out.append((f"{letters}{r.choice(ends)}", path(plain, letters), 1))
    # ordinary names as firms and persons coin them: parts of words run together, and short initials
    parts = sorted({w[i : i + n] for w in good for n in (2, 3, 4) for i in range(len(w) - n + 1)} | set("tion ment able ible ness ing ers est and the that with from over less ful ous ive ant ent".split()))
    for i in range(1500):
        name = "".join(r.choice(parts) for _ in range(r.randint(2, 4))) if i % 5 else "".join(r.choice(_LOWER) for _ in range(r.randint(2, 7)))
        out.append((f"{r.choice(subs)}{name}{r.choice(ends)}", path(plain, name), 0))
    return out


def _held_out(rows: list[tuple[str, str, int]]) -> list[tuple[float, int]]:
    """Score and label of the rows whose host's crc32 is divisible by 5, after training on the others: no host is on both sides."""
    w = train([x for x in rows if zlib.crc32(x[0].encode()) % 5])
    return [(score(h, p, w), y) for h, p, y in rows if zlib.crc32(h.encode()) % 5 == 0]


def fitted_threshold(rows: list[tuple[str, str, int]], false_blocks: float = 0.005) -> float:
    """The least threshold from 0.5 on over which at most this share of the ordinary rows held out is blocked."""
    ordinary = sorted((s for s, y in _held_out(rows) if not y), reverse=True)
    return max(0.5, ordinary[int(len(ordinary) * false_blocks)]) if ordinary else 0.5


def quality(rows: list[tuple[str, str, int]], threshold: float = 0.5) -> tuple[float, float, int]:
    """Precision and recall of block, and the number of rows, on the rows held out."""
    said = [(s > threshold, y) for s, y in _held_out(rows)]
    hit = sum(1 for s, y in said if s and y)
    return hit / max(1, sum(s for s, _ in said)), hit / max(1, sum(y for _, y in said)), len(said)


def features(host: str, path: str) -> np.ndarray:
    """Places of the character n-grams of host and path; those of the two don't mix."""
    found = set()
    for tag, text in (("h", host), ("p", path)):
        text = f"^{text}$"
        for n in GRAMS:
            found.update(zlib.crc32(f"{tag}{text[i : i + n]}".encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1) for i in range(len(text) - n + 1))
    return np.fromiter(found, dtype=np.int64, count=len(found))


def train(rows: list[tuple[str, str, int]], passes: int = 15, rate: float = 0.5, keep: float = 1e-4, seed: int = 11) -> np.ndarray:
    """Weights, the bias last. The labelled table is read whole; it must fit the driver (some thousand rows)."""
    w = np.zeros((1 << BITS) + 1)
    data = [(features(h, p), y) for h, p, y in rows]
    r = np.random.default_rng(seed)
    for t in range(passes):
        step = rate / (1 + 0.2 * t)
        for i in r.permutation(len(data)):
            x, y = data[i]
            if not len(x):
                continue
            scale = 1 / np.sqrt(len(x))
            p = 1 / (1 + np.exp(-(w[x].sum() * scale + w[-1])))
            w[x] -= step * ((p - y) * scale + keep * w[x])
            w[-1] -= 0.1 * step * (p - y)
    return w


def score(host: str, path: str, w: np.ndarray) -> float:
    x = features(host, path)
    return float(1 / (1 + np.exp(-(w[x].sum() / np.sqrt(max(1, len(x))) + w[-1]))))


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).otherwise(F.lit(""))
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise(F.lit("")), F.lit(""))


def _rule(rules: list[tuple[str, str, str]]) -> Column:
    """rules: (verdict, host, path). The longest that fits, as (verdict, rule)."""
    out = F.when(F.lit(False), F.struct(F.lit("").alias("verdict"), F.lit("").alias("rule")))
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        out = out.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(host + path).alias("rule")))
    return out


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], table: list[tuple[str, str, int]] | None = None, threshold: float | None = None) -> DataFrame:
    """One row for each row of pages: page_id, host, path, rule, verdict, score.

    pages: page_id, url. A null url, or one without `://`, has an empty host and path, and no rule fits it. rules: at most
    200; they are part of the plan. score is the regression's probability of block for all rows; it decides where no rule
    fits, where it is over the threshold; without one, over the table's fitted_threshold(). Repeated rows are judged each, and urls of any length whole; extra columns, whatever their names, are ignored; an
    empty table gives no rows.
    """
    if len(rules) > 200:
        raise ValueError("more than 200 rules")
    small_batches(pages.sparkSession)
    known = table or labelled()
    w, limit = train(known), fitted_threshold(known) if threshold is None else threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[tuple[str, str], float] = {}
        for batch in batches:
            found = []
            for pair in zip(values(batch, 1), values(batch, 2), strict=True):
                if pair not in met:
                    if len(met) > 100_000:
                        met.clear()
                    met[pair] = score(*pair, w)
                found.append(met[pair])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=["page_id", "host", "path", "score"])

    url = F.col("url")
    of = only(pages, "page_id", "url").select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    of = of.mapInArrow(run, "page_id long, host string, path string, score double").withColumn("_rule", _rule(rules))
    own = F.when(F.col("score") > limit, "block").otherwise("allow")
    return of.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", own).alias("verdict"), "score")
