"""Personal data: validated numbers, dates and addresses become pseudonyms of their own format.

A pseudonym is a keyed Feistel permutation within the set of valid values: equal values get equal pseudonyms in all
documents, different values different ones. restore() inverts it with the key where a text is cut into the same values before and after;
see there. All work on texts is made of DataFrame functions.

kind   what is taken                                              its set
email  local part of an address                                   same length, each letter case and digit in its place
card   13 to 19 digits, blanks or hyphens between, Luhn-valid      same first digit and length, Luhn-valid
ssn    ddd-dd-dddd with a valid area, group and serial             all valid ones
phone  10 digits with separators, +1 before or not, valid codes    all with valid area and exchange codes
ip     four octets of at most 255                                  all IPv4 addresses
date   yyyy-mm-dd, dd/mm/yyyy or dd.mm.yyyy, 1800 to 2199          all days of these 400 years

All patterns but the card's match valid values only, so what fails its check consumes nothing. Cards are looked for in the
text between the others' matches. There a run of numbers with one blank or hyphen between them may hold several cards and
other numbers: see _cards.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

KINDS = ("email", "card", "ssn", "phone", "ip", "date")
_YEAR, _LEAP = "(?:1[89]|2[01])[0-9]{2}", "(?:(?:1[89]|2[01])(?:0[48]|[2468][048]|[13579][26])|2000)"
_MONTHS = (("(?:0[13578]|1[02])", "(?:0[1-9]|[12][0-9]|3[01])"), ("(?:0[469]|11)", "(?:0[1-9]|[12][0-9]|30)"), ("02", "(?:0[1-9]|1[0-9]|2[0-8])"))
_ISO = "|".join([f"{_YEAR}-{m}-{d}" for m, d in _MONTHS] + [f"{_LEAP}-02-29"])
_DAY_FIRST = "|".join(x for s in ("/", "[.]") for x in [f"{d}{s}{m}{s}{_YEAR}" for m, d in _MONTHS] + [f"29{s}02{s}{_LEAP}"])
_OCTET = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "ssn": r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "date": rf"(?<![0-9A-Za-z])(?:{_ISO}|{_DAY_FIRST})(?![0-9A-Za-z])",
}
ANY = "|".join(PATTERNS.values())
#: A run of whole numbers, none with a letter at it, of 13 digits at least.
RUN = r"(?<![0-9A-Za-z])(?=(?:[0-9][ -]?){12}[0-9])[0-9]++(?![A-Za-z])(?:[ -][0-9]++(?![A-Za-z]))*+"
#: How cards are written.
LAYOUT = "^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{5}|[0-9]{4}(?:[ -][0-9]{3}){3})$"
ROUNDS = 8
#: 400 Gregorian years are 146097 = 189 * 773 days.
FIRST_DAY = "1800-01-01"


def _hash(key: str, tweak: str, i: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), i.cast("string"), half).cast("binary"), 256)


class Key(NamedTuple):
    """secret: known to those who may invert. back: whether pseudonyms are made or undone."""

    secret: str
    back: bool = False

    def rounds(self) -> Column:
        order = (F.lit(0), F.lit(ROUNDS - 1))
        return F.sequence(*(order[::-1] if self.back else order))


def feistel(value: Column, a: int, b: int, key: Key, tweak: str) -> Column:
    """A permutation of 0 .. a * b - 1: the halves of a mixed-radix number are in turn shifted by a hash of the other."""

    def turn(s: Column, i: Column) -> Column:
        sign = -1 if key.back else 1
        f = lambda half: sign * F.conv(F.substring(_hash(key.secret, tweak, i, half.cast("string")), 1, 14), 16, 10).cast("long")
        return F.when(i % 2 == 0, F.struct(F.pmod(s["l"] + f(s["r"]), F.lit(a)).cast("long").alias("l"), s["r"].alias("r"))).otherwise(F.struct(s["l"].alias("l"), F.pmod(s["r"] + f(s["l"]), F.lit(b)).cast("long").alias("r")))

    v = value.cast("long")
    return F.aggregate(key.rounds(), F.struct(F.floor(v / b).cast("long").alias("l"), (v % b).alias("r")), turn, lambda s: s["l"] * b + s["r"])


def feistel_text(text: Column, key: Key, tweak: str) -> Column:
    """A permutation of strings that keeps letter case, digits and all other characters in their places: the halves are in
    turn shifted, each character within its class, by hashes of the other, one for 32 characters."""
    n = F.length(text)
    cut = F.floor(n / 2).cast("int")

    def shifted(half: Column, other: Column, i: Column) -> Column:
        one = lambda k: _hash(key.secret, tweak, i, F.concat_ws("|", n.cast("string"), other) if k is None else F.concat_ws("|", n.cast("string"), other, k.cast("string")))
        stream = F.when(F.length(half) <= 32, one(None)).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.length(half) - 1) / 32).cast("int")), one), ""))

        def move(c: Column, k: Column) -> Column:
            h = F.conv(F.substring(stream, (2 * k + 1).cast("int"), F.lit(2)), 16, 10).cast("int")
            code = F.ascii(c)
            within = lambda first, size: F.char((F.pmod(code - first + (-h if key.back else h), F.lit(size)) + first).cast("long"))
            return F.when(c.rlike("^[a-z]$"), within(97, 26)).when(c.rlike("^[A-Z]$"), within(65, 26)).when(c.rlike("^[0-9]$"), within(48, 10)).otherwise(c)

        return F.array_join(F.transform(F.split(half, ""), move), "")

    def turn(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.struct(shifted(s["l"], s["r"], i).alias("l"), s["r"].alias("r"))).otherwise(F.struct(s["l"].alias("l"), shifted(s["r"], s["l"], i).alias("r")))

    start = F.struct(F.substring(text, F.lit(1), cut).alias("l"), F.substring(text, cut + 1, n).alias("r"))
    return F.aggregate(key.rounds(), start, turn, lambda s: F.concat(s["l"], s["r"]))


def _luhn(digits: Column) -> Column:
    """Sum of Luhn's rule over digits, the last one counting once."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x)


def _refill(pattern: Column, digits: Column) -> Column:
    """The pattern with its digits replaced, one after another."""
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
    turn = lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct((s["at"] + 1).alias("at"), F.concat(s["out"], F.substring(digits, s["at"], F.lit(1))).alias("out"))).otherwise(F.struct(s["at"].alias("at"), F.concat(s["out"], c).alias("out")))
    return F.aggregate(F.split(pattern, ""), start, turn, lambda s: s["out"])


def _int(text: Column, start: int, n: int) -> Column:
    return F.substring(text, start, n).cast("long")


def _pad(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _card(m: Column, key: Key) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    middle = feistel_text(F.substring(digits, F.lit(2), F.length(digits) - 2), key, "card")
    body = F.concat(F.substring(digits, 1, 1), middle)
    whole = lambda b: F.concat(b, ((10 - _luhn(F.concat(b, F.lit("0"))) % 10) % 10).cast("string"))
    return _bound(_bound(body, whole), lambda d: _refill(m, d))


def _bound(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _cards(run: Column, key: Key) -> Column:
    """(new, n) for a run of numbers. A card is made of whole numbers of the run, of 13 to 19 digits in all and Luhn-valid,
    either in a usual layout or from the start of what is left of the run or up to its end. At each number, from the left,
    usual layouts come first and then long cards; what isn't in a card stays."""

    def of(groups: Column) -> Column:
        n = F.size(groups)

        def turn(s: Column, i: Column) -> Column:
            tries = F.transform(F.sequence(F.lit(1), F.least(F.lit(19), n - i + 1)), lambda k: F.struct(k.alias("k"), F.regexp_replace(F.array_join(F.slice(groups, i, k), ""), "[ -]$", "").alias("m")))
            tries = F.transform(F.filter(tries, lambda t: F.length(t["m"]) > 12), lambda t: F.struct((~t["m"].rlike(LAYOUT)).alias("odd"), (-t["k"]).alias("less"), t["m"].alias("m"), F.regexp_replace(t["m"], "[^0-9]", "").alias("digits")))
            fits = F.filter(tries, lambda t: F.length(t["digits"]).between(13, 19) & (~t["odd"] | (i == s["left"]) | (i - t["less"] > n)) & (_luhn(t["digits"]) % 10 == 0))
            kept = F.struct(s["left"].alias("left"), (s["next"] + 1).alias("next"), s["n"].alias("n"), F.concat(s["new"], F.element_at(groups, i)).alias("new"))

            def taken(best: Column) -> Column:
                end = i - best["less"]
                new = F.concat(s["new"], _card(best["m"], key), F.regexp_extract(F.element_at(groups, end - 1), "[ -]?$", 0))
                return F.when(best.isNull(), kept).otherwise(F.struct(end.alias("left"), end.alias("next"), (s["n"] + 1).alias("n"), new.alias("new")))

            within = (i != s["left"]) & (n - i > 18) & ~F.element_at(groups, i).rlike("^[0-9]{4}")  # no layout, nor an end of the run
            return F.when(i < s["next"], s).when(within, kept).otherwise(_bound(F.get(F.array_sort(fits), F.lit(0)), taken))

        start = F.struct(F.lit(1).alias("left"), F.lit(1).alias("next"), F.lit(0).alias("n"), F.lit("").alias("new"))
        return F.aggregate(F.sequence(F.lit(1), n), start, turn, lambda s: F.struct(s["new"].alias("new"), s["n"].alias("n")))

    return _bound(F.regexp_extract_all(run, F.lit("[0-9]+[ -]?"), F.lit(0)), of)


def _gap(gap: Column, key: Key) -> Column:
    """(new, n) for text between other values."""
    runs = F.transform(F.regexp_extract_all(gap, F.lit(RUN), F.lit(0)), lambda r: _cards(r, key))
    filled = lambda rs: F.array_join(F.flatten(F.zip_with(F.split(gap, RUN, -1), rs, lambda g, r: F.array(g, F.coalesce(r["new"], F.lit(""))))), "")
    many = lambda rs: F.aggregate(rs, F.lit(0), lambda s, r: s + r["n"])
    return F.when(gap.rlike(RUN), _bound(runs, lambda rs: F.struct(filled(rs).alias("new"), many(rs).alias("n")))).otherwise(F.struct(gap.alias("new"), F.lit(0).alias("n")))


def _pseudonym(m: Column, key: Key) -> Column:
    """(kind, new) for one match of ANY."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    is_ = {k: m.rlike(f"^(?:{p})$") for k, p in PATTERNS.items()}

    email = F.concat(feistel_text(F.substring_index(m, "@", 1), key, "email"), F.lit("@"), F.substring_index(m, "@", -1))

    area, group, serial = _int(digits, 1, 3), _int(digits, 4, 2), _int(digits, 6, 4)
    ssn_new = feistel((area - F.when(area > 666, 2).otherwise(1)) * 989901 + (group - 1) * 9999 + serial - 1, 898, 989901, key, "ssn")
    new_area = F.floor(ssn_new / 989901)
    ssn = F.concat_ws("-", _pad(new_area + F.when(new_area >= 665, 2).otherwise(1), 3), _pad(F.floor(ssn_new % 989901 / 9999) + 1, 2), _pad(ssn_new % 9999 + 1, 4))

    national = F.right(digits, F.lit(10))
    code, exchange = _int(national, 1, 3), _int(national, 4, 3)
    phone_new = feistel(((code - 200) * 800 + exchange - 200) * 10000 + _int(national, 7, 4), 80000, 80000, key, "phone")
    phone_digits = F.concat(_pad(F.floor(phone_new / 8000000) + 200, 3), _pad(F.floor(phone_new / 10000) % 800 + 200, 3), _pad(phone_new % 10000, 4))
    phone = _refill(m, F.concat(F.when(F.length(digits) > 10, "1").otherwise(""), phone_digits))

    octets = F.transform(F.split(m, r"\."), lambda o: F.try_to_number(o, F.lit("999")).cast("long"))
    ip_new = feistel(F.aggregate(octets, F.lit(0).cast("long"), lambda s, o: s * 256 + o), 65536, 65536, key, "ip")
    ip = F.concat_ws(".", *(F.shiftright(ip_new, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)))

    iso = F.when(m.rlike("^[0-9]{4}-"), m).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    day = F.datediff(F.try_to_date(iso, "yyyy-MM-dd"), F.to_date(F.lit(FIRST_DAY)))
    new_day = F.date_add(F.to_date(F.lit(FIRST_DAY)), feistel(day, 189, 773, key, "date").cast("int"))
    date = F.when(m.rlike("^[0-9]{4}-"), F.date_format(new_day, "yyyy-MM-dd")).otherwise(F.concat(F.date_format(new_day, "dd"), F.substring(m, 3, 1), F.date_format(new_day, "MM"), F.substring(m, 3, 1), F.date_format(new_day, "yyyy")))

    out = F.when(is_["email"], F.struct(F.lit(KINDS.index("email")).alias("kind"), email.alias("new")))
    for kind, new in (("ssn", ssn), ("phone", phone), ("ip", ip), ("date", date)):
        out = out.when(is_[kind], F.struct(F.lit(KINDS.index(kind)).alias("kind"), new.alias("new")))
    return out.otherwise(F.struct(F.lit(-1).alias("kind"), m.alias("new")))


def _is_kind(i: int):
    return lambda p: p["kind"] == i


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """docs (doc_id, text, and any others) with text replaced and n_email, n_card, n_ssn, n_phone, n_ip, n_date, the number
    of values replaced. key: a secret of the caller's.

    A null text stays null and has none, like an empty one. Texts are read whole, whatever their length; values that stand in
    repeated rows or in several texts get one pseudonym. Other columns, whatever their names, stay as they are, but for
    those of the counts' names, which are replaced. An empty table gives no rows.
    """
    return _turned(docs, Key(key))


def restore(docs: DataFrame, key: str) -> DataFrame:
    """The inverse: rows that pseudonymize() made with this key, with their values in place of the pseudonyms.

    It isn't whole: where a card stands in a run with further digits, its pseudonym and these may happen to be valid in another
    usual layout, and are then read otherwise than the text was (of 300 texts with a card and three more digits, 18); and octets
    with leading zeros come back without them.
    """
    return _turned(docs, Key(key, back=True))


def _turned(docs: DataFrame, key: Key) -> DataFrame:
    counts = [f"n_{k}" for k in KINDS]
    text = text_or_empty()
    has = F.regexp_like(text, F.lit("[0-9@]"))
    none = F.array().cast("array<string>")
    found = F.when(has, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)
    gaps = F.when(has, F.split(text, ANY, -1)).otherwise(none)
    rest = [c for c in docs.columns if c.lower() not in counts]
    given = docs.select(F.struct(*(F.col(f"`{c}`") for c in rest)).alias("_given"), found.alias("_found"), gaps.alias("_gaps"))
    pairs = given.select("_given", F.transform("_found", lambda m: _pseudonym(m, key)).alias("_new"), F.transform("_gaps", lambda g: _gap(g, key)).alias("_gaps"))
    cards = F.aggregate("_gaps", F.lit(0), lambda s, g: s + g["n"])
    filled = F.array_join(F.flatten(F.zip_with("_gaps", "_new", lambda g, p: F.array(g["new"], F.coalesce(p["new"], F.lit(""))))), "")
    new = F.when((F.size("_new") > 0) | (cards > 0), filled).otherwise(F.col("_given.text"))
    many = [(cards if c == "n_card" else F.size(F.filter("_new", _is_kind(i)))).cast("long").alias(c) for i, c in enumerate(counts)]
    return pairs.select(*((new if c == "text" else F.col(f"_given.`{c}`")).alias(c) for c in rest), *many)
