"""Personal data (operator 13), by DataFrame functions only.

Patterns propose spans; checksums (Luhn, mod-97) and range rules confirm them;
words near a span adjust its score, and spans of at least THRESHOLD stay.

Four base kinds are kept whatever their score: email, ip (parts at most 255),
card (16 to 19 digits, Luhn) and phone (international, 8 to 15 digits), each
leftmost and non-overlapping, failing matches dropped. Added are

* card: 13 to 15 digits that pass Luhn, with an issuer's prefix or a word such
  as "card" near by; in a run of digits that failed, the first window of whole
  groups that has a card's shape (16, 4-4-4-4, 15, 4-6-5), prefix and checksum;
* phone: national numbers, after an area code in parentheses or near a word
  such as "phone";
* email: addresses written with "(at)" and "(dot)"; ip: IPv6 addresses;
* iban: country length and mod-97; ssn: US social security numbers.

Positions come from the pieces between matches (``split``) and the matches
themselves, added up in one pass over a text's matches, so a text is one row
throughout and nothing is shuffled. The patterns do not backtrack over long
runs; they find what the contract's plain patterns find.

Defined results: a null or empty text has no spans. Repeated rows and null ids
each give their own row. Offsets count code points, end exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 50  # scores are in hundredths
NEAR = 48  # code points looked at before and after a span
CHUNK = 128

LOCAL = "[A-Za-z0-9._%+-]"
# a match may start inside a run of these characters only where the last one ended
EMAIL = rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
DIGITS = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
WRITTEN_EMAIL = rf"(?:\G|(?<!{LOCAL})){LOCAL}++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]++)++"
IPV6 = r"[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7}"
IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}"

OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$"
ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6)"
SSN = r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
NO_SSN = r"^(?:000|666|9)|-00-|0000$"
NATIONAL = r"^(?:[0-9]{3}[ -][0-9]{3}[ -][0-9]{4}|00[1-9][0-9 -]{8,17})$"
AREA = r"\([0-9]{3}\) ?$"
SUBSCRIBER = r"^[0-9]{3}[ -][0-9]{4}$"
IN_PHONE = r"\+(?:[0-9][ ().0-9-]*)?$"

# Words that speak for a kind, and words that speak against personal data.
FOR = {
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "cvv", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "cell", "fax", "sms", "telefon", "handy", "portable", "telefono"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
    "ip": ("ip", "ipv6", "address", "host", "server", "adresse"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "email": ("email", "mail", "contact", "write"),
}
AGAINST = ("isbn", "issn", "order", "part", "serial", "version", "invoice", "ticket")
# The length of an IBAN by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "KW": 30, "KZ": 20,
    "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MT": 31, "NL": 18, "NO": 15,
    "PK": 24, "PL": 28, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24,
    "TR": 26, "UA": 29, "XK": 20,
}
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

HIT = "struct<start:int,hit:string,before:string,after:string>"
SPAN = "struct<kind:int,start:int,end:int,score:int,base:boolean>"


def let(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def located(text: Column, pattern: str, near: bool = True) -> Column:
    """All matches with their places and, if wanted, what stands near them.

    The pieces between matches and the matches alternate; a place is the sum of
    the lengths before it: of the chunks before, then of the items before in its
    own chunk, so that many matches cost little more than their number.
    """
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit"),
                                                 (F.length(gap) + F.coalesce(F.length(hit), F.lit(0))).alias("n")))

    def total(some):
        return F.aggregate(some, F.lit(0), lambda n, x: n + x["n"])

    def sums(p):
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / CHUNK).cast("int")),
                             lambda k: F.struct(total(F.slice(p, k * CHUNK + 1, CHUNK)).alias("n")))
        return let(chunks, lambda c: F.transform(c, lambda x, k: total(F.slice(c, F.lit(1), k))))

    def placed(p, upto):
        def item(x, i):
            chunk = F.floor(i / CHUNK).cast("int")
            start = F.get(upto, chunk) + total(F.slice(p, chunk * CHUNK + 1, i % CHUNK)) + F.length(x["gap"])
            fields = [start.alias("start"), x["hit"].alias("hit")]
            if near:
                # neighbours are three code points at least, so NEAR / 3 of them are enough
                back = F.least(i, F.lit(NEAR // 3))
                earlier = F.array_join(F.transform(F.slice(p, i - back + 1, back), lambda y: F.concat(y["gap"], y["hit"])), "")
                fields += [F.right(F.concat(earlier, x["gap"]), F.lit(NEAR)).alias("before"),
                           F.left(F.get(p, i + 1)["gap"], F.lit(NEAR)).alias("after")]
            else:
                fields += [F.lit("").alias("before"), F.lit("").alias("after")]
            return F.struct(*fields)
        return F.filter(F.transform(p, item), lambda x: x["hit"].isNotNull())

    return let(pairs, lambda p: let(sums(p), lambda upto: placed(p, upto)))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    def add(total, d):
        v = d.cast("int")
        double = total["i"] % 2 == 1
        return F.struct((total["s"] + F.when(double, F.when(v > 4, 2 * v - 9).otherwise(2 * v)).otherwise(v)).alias("s"), (total["i"] + 1).alias("i"))

    zero = F.struct(F.lit(0).alias("s"), F.lit(0).alias("i"))
    return F.aggregate(F.split(F.reverse(digits), ""), zero, add, lambda t: t["s"] % 10 == 0)


def mod97(code: Column) -> Column:
    """Whether an IBAN's checksum holds: the first four signs go last, letters count as 10 to 35."""
    def add(rest, c):
        v = F.ascii(c)
        return F.when(v >= 65, (rest * 100 + v - 55) % 97).otherwise((rest * 10 + v - 48) % 97).cast("int")

    turned = F.concat(F.substr(code, F.lit(5)), F.left(code, F.lit(4)))
    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def words_near(hit: Column, words) -> Column:
    """Whether one of the words stands near the hit (as a word of its own)."""
    pattern = "(?:^|[^a-z])(?:" + "|".join(words) + ")(?:[^a-z]|$)"
    return F.lower(hit["before"]).rlike(pattern) | F.lower(hit["after"]).rlike(pattern)


def scored(hit: Column, kind: str, base_score) -> Column:
    """The score after the words near by."""
    base = base_score if isinstance(base_score, Column) else F.lit(base_score)
    return base + F.when(words_near(hit, FOR[kind]), 30).otherwise(0) - F.when(words_near(hit, AGAINST), 30).otherwise(0)


def span(kind: str, start: Column, end: Column, score: Column, base: bool = False) -> Column:
    return F.struct(F.lit(KINDS.index(kind)).alias("kind"), start.cast("int").alias("start"), end.cast("int").alias("end"),
                    score.cast("int").alias("score"), F.lit(base).alias("base"))


def whole(hit: Column, kind: str, score: Column, base: bool = False) -> Column:
    return span(kind, hit["start"], hit["start"] + F.length(hit["hit"]), score, base)


def card_windows(runs: Column) -> Column:
    """Of each run of groups of digits, the first window of whole groups with a card's shape, prefix and checksum:
    (at, start, end)."""
    def ahead(hit):
        # each group with the three after it; no lambda refers to the whole list
        groups = F.split(hit, "[ -]")
        out = groups
        for k in (2, 3, 4):
            out = F.zip_with(out, F.slice(F.split(hit, "[ -]"), k, F.length(hit)), lambda have, g: F.concat_ws("-", have, g))
        return out

    def shaped(four, i):
        three, one = F.substring_index(four, "-", 3), F.substring_index(four, "-", 1)
        card = F.when(four.rlike(r"^[0-9]{4}(?:-[0-9]{4}){3}$"), four).when(three.rlike(r"^3[47][0-9]{2}-[0-9]{6}-[0-9]{5}$"), three) \
            .when(one.rlike(r"^(?:[0-9]{16}|3[47][0-9]{13})$"), one)
        return F.struct(i.alias("i"), card.alias("w"))

    def first(d):
        good = F.filter(F.transform(ahead(d["at"]["hit"]), shaped),
                        lambda x: x["w"].rlike(ISSUER) & luhn(F.replace(x["w"], F.lit("-"), F.lit(""))))
        return F.struct(d["at"].alias("at"), F.get(good, F.lit(0)).alias("first"))

    def placed(x):
        before = F.array_join(F.slice(F.split(x["at"]["hit"], "[ -]"), F.lit(1), x["first"]["i"]), "-")
        start = x["at"]["start"] + F.length(before) + F.when(x["first"]["i"] > 0, 1).otherwise(0)
        return F.struct(x["at"].alias("at"), start.alias("start"), F.length(x["first"]["w"]).alias("n"))

    return F.transform(F.filter(F.transform(runs, first), lambda x: x["first"].isNotNull()), placed)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its spans: (kind, start, end, score, base) in the order of KINDS, then by start."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    nothing = F.array().cast(f"array<{HIT}>")

    def hits(pattern, gate, near=False):
        return F.when(gate, located(text, pattern, near)).otherwise(nothing)

    lengths = "".join(f"{country}{n}" for country, n in IBAN_LENGTH.items())
    number = text.rlike("[0-9][ -]?[0-9]")
    placed = docs.select(
        "doc_id",
        hits(EMAIL, text.contains("@")).alias("email"),
        hits(IP, text.rlike(r"[0-9]\.[0-9]")).alias("ip"),
        hits(DIGITS, number, True).alias("run"),
        hits(PHONE, text.contains("+")).alias("phone"),
        hits(WRITTEN_EMAIL, text.rlike(r"[\[(]at[\])]"), True).alias("written"),
        hits(IPV6, text.rlike(":[0-9A-Fa-f]{1,4}:"), True).alias("ipv6"),
        hits(IBAN, text.rlike("[A-Z]{2}[0-9]{2}"), True).alias("iban"),
    )
    plain = F.transform("run", lambda d: F.struct(d.alias("at"), F.regexp_replace(d["hit"], "[ -]", "").alias("digits")))
    judged = F.transform(plain, lambda d: F.struct(
        d["at"].alias("at"), d["digits"].alias("digits"), F.length(d["digits"]).alias("n"),
        (F.length(d["digits"]).between(13, 19) & luhn(d["digits"])).alias("sound")))
    placed = placed.withColumn("run", judged)

    def runs(cond, make):
        return F.transform(F.filter("run", cond), make)

    def is_card(d):
        return d["sound"] & (d["n"] >= 16)

    def outside(d):
        return ~d["at"]["before"].rlike(IN_PHONE)

    def with_area(d):
        area = F.length(F.regexp_extract(d["at"]["before"], AREA, 0))
        return span("phone", d["at"]["start"] - area, d["at"]["start"] + F.length(d["at"]["hit"]), scored(d["at"], "phone", 60))

    def iban(h):
        code = F.replace(h["hit"], F.lit(" "), F.lit(""))
        at = F.instr(F.lit(lengths), F.left(code, F.lit(2)))
        size = F.when(at > 0, F.substr(F.lit(lengths), at + 2, F.lit(2)).cast("int")).otherwise(99)
        return F.struct(h.alias("at"), code.alias("code"), size.alias("size"))

    def iban_end(x):
        upto = F.filter(F.sequence(F.lit(1), F.length(x["at"]["hit"])),
                        lambda p: F.length(F.replace(F.left(x["at"]["hit"], p), F.lit(" "), F.lit(""))) == x["size"])
        return F.struct(x["at"].alias("at"), F.left(x["code"], x["size"]).alias("code"), F.get(upto, F.lit(0)).alias("n"))

    def sound_iban(x):
        follows = F.substr(F.concat(x["at"]["hit"], x["at"]["after"]), x["n"] + 1, F.lit(1))
        return x["n"].isNotNull() & ~x["at"]["before"].rlike("[A-Za-z0-9]$") & ~follows.rlike("[A-Za-z0-9]") & mod97(x["code"])

    def ipv6(h):
        parts = F.size(F.split(h["hit"], ":{1,2}"))
        short = F.size(F.split(h["hit"], "::")) - 1
        alone = ~h["before"].rlike("[0-9A-Za-z:.]$") & ~h["after"].rlike("^[0-9A-Za-z:]")
        good = alone & (((parts == 8) & (short == 0)) | ((parts < 8) & (short == 1))) & h["hit"].rlike("[0-9]")
        return whole(h, "ip", F.when(good, scored(h, "ip", F.when(short == 0, 60).otherwise(45))).otherwise(0))

    sure = F.lit(100)
    base = [
        F.transform("email", lambda h: whole(h, "email", sure, True)),
        F.transform(F.filter("ip", lambda h: h["hit"].rlike(OCTETS)), lambda h: whole(h, "ip", sure, True)),
        F.transform(F.filter("run", is_card), lambda d: whole(d["at"], "card", sure, True)),
        F.transform(F.filter("phone", lambda h: F.length(F.regexp_replace(h["hit"], "[^0-9]", "")).between(8, 15)),
                    lambda h: whole(h, "phone", sure, True)),
    ]
    added = [
        runs(lambda d: d["sound"] & (d["n"] < 16) & outside(d),
             lambda d: whole(d["at"], "card", scored(d["at"], "card", F.when(d["digits"].rlike(r"^(?:3[47].{13}|3[068].{12}|4.{12})$"), 55).otherwise(25)))),
        F.transform(card_windows(F.filter("run", lambda d: ~is_card(d) & (d["n"] > 15) & outside(d))),
                    lambda x: span("card", x["start"], x["start"] + x["n"], scored(x["at"], "card", 60))),
        runs(lambda d: d["at"]["hit"].rlike(NATIONAL) & outside(d), lambda d: whole(d["at"], "phone", scored(d["at"], "phone", 30))),
        runs(lambda d: d["at"]["hit"].rlike(SUBSCRIBER) & d["at"]["before"].rlike(AREA)
             & ~F.regexp_replace(d["at"]["before"], AREA, "").rlike(IN_PHONE), with_area),
        runs(lambda d: d["at"]["hit"].rlike(SSN) & ~d["at"]["hit"].rlike(NO_SSN) & outside(d),
             lambda d: whole(d["at"], "ssn", scored(d["at"], "ssn", 55))),
        F.transform("written", lambda h: whole(h, "email", scored(h, "email", 70))),
        F.transform("ipv6", ipv6),
        F.transform(F.filter(F.transform(F.transform("iban", iban), iban_end), sound_iban),
                    lambda x: span("iban", x["at"]["start"], x["at"]["start"] + x["n"], scored(x["at"], "iban", 90))),
    ]
    added = [F.filter(s, lambda x: x["score"] >= THRESHOLD) for s in added]
    spans = reduce(lambda a, b: F.concat(a, b), [s.cast(f"array<{SPAN}>") for s in base + added])
    return placed.select("doc_id", F.array_sort(spans).alias("spans"))


def named(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the base spans' counts by kind and their sha256, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])
    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.withColumn("base", base).select(
        "doc_id", *[count(k) for k in BASE_KINDS], F.sha2(named(F.col("base")).cast("binary"), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"))
