"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Both models are character bigram tables trained from labelled samples; a token's score is its log-likelihood under the
model of random strings less that under the model of identifiers, per character. Everything that touches texts is made of
DataFrame functions.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only, text_or_empty

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: For these two, leftmost matches that are long enough are the long ones among all leftmost matches: both take whole runs.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: What the models judge, as group 1 at the end of a match: runs of token characters that no fixed pattern takes, from 20 on,
#: or from 8 on next to what a fixed pattern takes.
_FIXED = r"(?:(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6,}|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,})"
_CHAR = "[A-Za-z0-9+/_=-]"
_FREE = f"(?:(?!{_FIXED}){_CHAR})"
FREE = f"(?:{_FIXED}|(?<!{_CHAR})(?={_CHAR}{{8}})(?={_FREE}{{20}}|{_FREE}{{8,}}+{_FIXED}))({_FREE}{{8,}}+)?"
#: What a text with such a run has at least; cheap to look for.
GATE = f"(?<!{_CHAR})(?:{_CHAR}{{20}}|{_CHAR}{{8,}}?(?i:pass|secret|token|api))"
#: Matches that are counted through one by one.
RUN = 256
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
KINDS = ("assign", "access", "hex", "random")


def samples(n: int = 2000, seed: int = 7) -> list[tuple[str, int]]:
    """Labelled samples: 1 for random strings (base64, hexadecimal, upper case with digits), 0 for identifiers, paths and
    runs of words, made from parts of English and programming words by rule."""
    r = random.Random(seed)
    parts = (
        "get set make read write open close load save find list user name file path data base time date count index value key type node tree graph table row column "
        "query plan join group order limit parse token stream buffer cache queue thread task worker driver cluster server client request response header body error log "
        "test case mock main init start stop run build source target input output config option flag default global local static public private class object method "
        "function return string number array map filter reduce sort merge split hash random sample model train batch layer weight bias learn rate loss score metric "
        "house water light green paper stone river north summer winter people country language history science market letter picture music garden window street"
    ).split()
    out = []
    for i in range(n):
        alphabet = ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")[i % 4]
        out.append(("".join(r.choice(alphabet) for _ in range(r.randint(20, 60))), 1))
        words = [r.choice(parts) for _ in range(r.randint(4, 9))]
        form = i % 6
        text = "_".join(words) if form == 0 else "-".join(words) if form == 1 else "/".join(words) if form == 2 else "".join(w.title() for w in words) if form == 3 else "_".join(words).upper() if form == 4 else "".join(words)
        if r.random() < 0.4:
            text += f"{r.choice('_-/')}{r.randint(0, 2030)}"
        out.append((text, 0))
    plain = random.Random(seed + 1)  # ordinary words and numbers, and random strings of letters alone
    foreign = (
        "schaft gesellschaft versicherung rechts schutz dampf schiff fahrt donau haupt bahn hof arbeit zeit verkehr ordnung wissen land kraft werk stadt verwaltung freund lich keit ung "
        "gouverne ment nation ale ment constitution elle developpe ment question histoire univers ite desarrollo comunica cion respon sabilidad inter nacional administra tiva mente"
    ).split()
    for i in range(n):
        text = "".join(plain.choice((parts, foreign)[i % 2]) for _ in range(plain.randint(4, 9)))
        out.append(((text, text.upper(), text.capitalize())[i % 3], 0))
        start = plain.randint(1900, 2030)
        numbers = ("-".join(str(start + j) for j in range(6)), "".join(str(plain.randint(0, 9)) for _ in range(plain.randint(20, 40))), f"{start}-{plain.randint(1, 12):02}-{plain.randint(1, 28):02}/{start}-{plain.randint(1, 12):02}-{plain.randint(1, 28):02}", "/".join(str(plain.randint(0, 999)) for _ in range(8)))
        out += [(numbers[i % 4], 0)] * 2
        letters = ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")[i % 3]
        out.append(("".join(plain.choice(letters) for _ in range(plain.randint(20, 60))), 1))
    out += [(c * 40, 0) for c in "=-_/0aA1x"] + [("0123456789" * 4, 0), ("abcdefghijklmnopqrstuvwxyz" * 2, 0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 2, 0)]
    return out


def train(labelled: list[tuple[str, int]]) -> np.ndarray:
    """Log-likelihood ratios of character pairs: [first, second], with the alphabet's size as the place before a token."""
    size = len(ALPHABET)
    place = {c: i for i, c in enumerate(ALPHABET)}
    count = np.full((2, size + 1, size), 0.25)
    for text, label in labelled:
        before = size
        for c in text:
            if c in place:
                count[label, before, place[c]] += 1
                before = place[c]
    logs = np.log(count / count.sum(axis=2, keepdims=True))
    return logs[1] - logs[0]


def ratio(text: str, table: np.ndarray) -> float:
    """The same score as the DataFrame expression gives, for one token."""
    before, total = len(ALPHABET), 0.0
    for c in text:
        at = ALPHABET.index(c)
        total += round(float(table[before, at]), 4)
        before = at
    return total / len(text)


def _ratio(token: Column, table: np.ndarray) -> Column:
    size = len(ALPHABET)
    flat = F.array(*(F.lit(round(float(x), 4)) for x in table.ravel()))
    at = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = F.zip_with(at, F.concat(F.array(F.lit(size + 1)), F.slice(at, 1, F.size(at) - 1)), lambda b, a: (a - 1) * size + b)
    return F.aggregate(pairs, F.lit(0.0), lambda s, i: s + F.element_at(flat, i)) / F.size(at)


def _spans(text: Column, pattern: str, kind: int, group: int | None = None, least: int = 0, tail: bool = False, gate: str | None = None) -> Column:
    """All leftmost matches in code points: array of (start, kind, end, token). Matches whose group is shorter than least
    are dropped after matching, as they still consume their text. With tail, spans are the groups, at the ends of matches. Starts are sums over all matches before: they are added
    up in runs of RUN matches first and then over the runs, so the work of a text does not grow with the square of its
    matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    none = F.array().cast("array<struct<start:int,kind:int,end:int,token:string>>")

    def of(rows: Column) -> Column:
        n = F.size(rows)
        runs = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / RUN).cast("int")), lambda i: F.slice(rows, i * RUN + 1, F.lit(RUN)))
        return _bound(F.transform(runs, within), joined)

    def within(run: Column) -> Column:
        """(length, out): what the run covers, and its matches with starts from 0."""
        empty = F.struct(F.lit(0).alias("length"), none.alias("out"))

        def turn(a: Column, r: Column) -> Column:
            at = a["length"] + r["gap"]
            start = at + F.length(r["all"]) - F.length(r["part"]) if tail else at
            one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (at + F.length(r["all"])).alias("end"), r["part"].alias("token"))
            return F.struct((at + F.coalesce(F.length(r["all"]), F.lit(0))).alias("length"), F.concat(a["out"], F.array(one)).alias("out"))

        return F.aggregate(run, empty, turn)

    def joined(runs: Column) -> Column:
        starts = F.aggregate(runs, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda a, r: F.struct((a["at"] + r["length"]).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]
        moved = F.zip_with(runs, starts, lambda r, at: F.transform(r["out"], lambda m: F.struct((m["start"] + at).alias("start"), m["kind"].alias("kind"), (m["end"] + at).alias("end"), m["token"].alias("token"))))
        return F.filter(F.flatten(moved), lambda m: F.length(m["token"]) >= least)

    rows = F.arrays_zip(gaps.alias("gap"), found.alias("all"), part.alias("part"))
    has = F.regexp_like(text, F.lit(pattern))
    return F.when(has if gate is None else F.regexp_like(text, F.lit(gate)) & has, _bound(rows, of)).otherwise(none)


def _bound(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, threshold: float = 0.5, labelled: list[tuple[str, int]] | None = None) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, base and more, arrays of (start, kind, end, token), ends
    exclusive, in code points. kind counts KINDS from 0. more holds the models' spans, of what FREE takes; the ratio judges
    all of it.

    A null text is the empty one, with two empty arrays. Texts are read whole, whatever their length; repeated rows are
    scanned each. An empty table gives no rows; other columns, whatever their names, are ignored.
    """
    table = train(labelled or samples())
    text = F.col("text")
    of = only(docs, "doc_id", "text").select("doc_id", text_or_empty().alias("text"))
    of = of.select("doc_id", F.concat(_spans(text, ASSIGN, 0, 2, 6), _spans(text, ACCESS, 1), _spans(text, HEX, 2)).alias("base"), _spans(text, FREE, 3, 1, 1, tail=True, gate=GATE).alias("runs"))

    return of.select("doc_id", "base", F.filter("runs", lambda t: _ratio(t["token"], table) > threshold).alias("more"))


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans."""
    of = scan(docs, **options)
    many = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return of.select("doc_id", many(0).alias("n_assign"), many(1).alias("n_access"), many(2).alias("n_hex"), F.size("more").cast("long").alias("n_random"), F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.concat("base", "more")).alias("spans"))
