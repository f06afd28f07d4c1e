"""PII: format-preserving Feistel pseudonyms, built-in expressions only.

Candidates are cut out of the text by one pattern, runs of digit groups on
their group borders, validated (Luhn, calendar, number ranges), turned into a number of their own domain, permuted by a keyed
Feistel network over that domain and written back in the same format. A
permutation keeps equal values equal and unlike values apart, in every
document. Mail addresses get a keyed local part; secrets are masked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# The formats that are recognised.
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"
PHONE = (r"(?:\+?1[ .\-]?)?(?:\(\d{3}\) ?\d{3}[ .\-]?\d{4}|\d{3}[ .\-]\d{3}[ .\-]\d{4}|\d{10})")
SSN = r"\d{3}-\d{2}-\d{4}"
DATE = r"\d{4}-\d{2}-\d{2}"
CARD = r"\d(?:[ \-]?\d){12,18}"
CARD_LAYOUT = r"\d{4}([ \-])\d{4}\1\d{4}\1\d{4}|\d{4}([ \-])\d{6}\2\d{4,5}|\d{13,19}"
IPV4 = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
SECRET = r"AKIA[0-9A-Z]{16}|(?:password|token|secret|api_key)\s*[=:]\s*\"?[0-9A-Za-z+/_\-]{8,}\"?"
_FREE = r"(?<![0-9A-Za-z.\-])"
_END = r"(?![0-9A-Za-z]|[.\-][0-9])"
# A date before an ISO time, and phones that no run of digit groups holds whole.
_DATE_TIME = rf"{DATE}(?=[Tt]\d{{2}})"
_MARKED_PHONE = (r"(?:(?:\+?1[ .\-]?)?\(\d{3}\) ?\d{3}[ .\-]?\d{4}"
                 r"|\+1[ .\-]?(?:\d{3}[ .\-]\d{3}[ .\-]\d{4}|\d{10}))")
# Digit groups with one blank, dot or hyphen between, up to a word, a mail
# address or an ISO time; a last dot or hyphen says that digits and a letter
# follow. Possessive: Java does not recurse for each group.
_RUN = (r"(?=\d(?:[ .\-]?\d){3})\d++(?![A-Za-z])"
        rf"(?:(?![ .\-](?:[A-Za-z0-9._%+\-]*+@|{_DATE_TIME}))[ .\-]\d++(?![A-Za-z]))*+(?:[.\-](?=\d))?")
PATTERN = (f"{EMAIL}|(?<![0-9A-Za-z])(?:{SECRET})|{_FREE}{_DATE_TIME}"
           f"|(?<![0-9A-Za-z.\\-+]){_MARKED_PHONE}{_END}|{_FREE}{_RUN}")
HINT = r"[0-9@]|AKIA|password|token|secret|api_key"
MAX_GROUPS = 19            # digits, and so groups, of the longest value

# First digits of the card issuers' number ranges.
ISSUER = r"4|5[0-9]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[0-9]|6[0-9]"

# The calendar is permuted in eras of 270 * 270 days from this day on; the years
# 0001 to 9999 begin and end so many days from it, inside an era each.
ERA_START, ERA_SIDE = "1900-01-01", 270
FIRST_DAY, LAST_DAY = -693595, 2958463


def _round(key: str, kind: str, i: Column, x: Column, modulus: Column) -> Column:
    """Keyed round function: the first 60 bits of SHA-256, reduced."""
    seed = F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), modulus.cast("string"), x.cast("string"))
    return F.pmod(F.conv(F.substring(F.sha2(seed, 256), 1, 15), 16, 10).cast("bigint"), modulus)


def feistel(value: Column, a: Column, b: Column, kind: str, key: str) -> Column:
    """Keyed permutation of [0, a * b): the two halves take turns in adding a
    round function of the other one."""
    a, b = a.cast("bigint"), b.cast("bigint")
    start = F.struct(F.floor(value / b).cast("bigint").alias("l"), F.pmod(value, b).alias("r"),
                     a.alias("a"), b.alias("b"))
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    def step(s, i):
        left = F.pmod(s["l"] + _round(key, kind, i, s["r"], s["a"]), s["a"])
        right = F.pmod(s["r"] + _round(key, kind, i, s["l"], s["b"]), s["b"])
        odd = i % 2 == 1
        return F.struct(F.when(odd, left).otherwise(s["l"]).alias("l"),
                        F.when(odd, s["r"]).otherwise(right).alias("r"), s["a"].alias("a"), s["b"].alias("b"))
    return F.aggregate(rounds, start, step, lambda s: s["l"] * s["b"] + s["r"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def _into(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced in order by ``digits``."""
    return F.aggregate(
        F.split(text, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at"), digits.alias("d")),
        lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct(
            F.concat(s["out"], F.substring(s["d"], s["at"], F.lit(1))).alias("out"),
            (s["at"] + 1).alias("at"), s["d"].alias("d")))
        .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"), s["d"].alias("d"))),
        lambda s: s["out"])


def _pad(n: Column, width) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def luhn_sum(digits: Column, double_last: bool) -> Column:
    """Luhn sum, the last digit doubled or not."""
    def add(acc, d, i):
        v = d.cast("int") * F.when((F.length(digits) - i) % 2 == (1 if double_last else 0), 2).otherwise(1)
        return acc + v - F.when(v > 9, 9).otherwise(0)
    pairs = F.transform(F.array_remove(F.split(digits, ""), ""), lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    return F.aggregate(pairs, F.lit(0), lambda acc, p: add(acc, p["d"], p["i"]))


def kind_of(m: Column) -> Column:
    """The kind of a match, or null if it does not validate."""
    octets = F.split(m, r"\.")
    # A leading zero is no decimal octet, and its width could not be kept.
    ok_ip = F.forall(octets, lambda o: (o.cast("int") <= 255) & ~o.rlike("^0[0-9]"))
    area, group, serial = F.substring(m, 1, 3), F.substring(m, 5, 2), F.substring(m, 8, 4)
    card = m.rlike(f"^{CARD}$") & _digits(m).rlike(f"^(?:{ISSUER})") & (luhn_sum(_digits(m), False) % 10 == 0)
    ok_ssn = ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")
    return (F.when(m.rlike(f"^(?:{EMAIL})$"), "email")
            .when(m.rlike(f"^(?:{SECRET})$"), "secret")
            .when(m.rlike(f"^{DATE}$"), F.when(F.try_to_date(m, "yyyy-MM-dd").isNotNull(), "date"))
            .when(m.rlike(f"^{SSN}$"), F.when(ok_ssn, "ssn"))
            .when(m.rlike(f"^{IPV4}$"), F.when(ok_ip, "ip"))
            .when(m.rlike(f"^(?:{PHONE})$"), F.lit("phone"))
            .when(card, F.lit("card")))


def values(m: Column, key: str) -> Column:
    """(found, text) of a match: its values (kind, original, pseudonym) in
    order, and the match with the pseudonyms in place.

    A run of digit groups holds any number of values, on group borders: cards
    in a usual layout go first, then dates, phones and the like, then cards in
    other groupings, from left to right, longer ones first. Beside a dot no
    value begins or ends, beside a hyphen only a card.
    """
    run = m.rlike(f"^(?:{_RUN})$") | m.rlike(r"^[0-9].*[.\-]$")
    last = F.when(run, F.regexp_extract(m, r"[.\-]$", 0)).otherwise("")
    groups = F.when(run, F.regexp_extract_all(m, F.lit(r"[ .\-]?[0-9]+"), F.lit(0))).otherwise(F.array(m))

    def bare(x, i):
        return F.when(i > 0, F.substring(x, F.lit(2), F.length(x))).otherwise(x)

    def tried(s, i):
        def of(n):
            text = bare(F.array_join(F.slice(s["g"], i + 1, n), ""), i)
            left = F.when(i > 0, F.substring(s["g"][i], 1, 1)).otherwise("")
            right = F.coalesce(F.substring(F.get(s["g"], i + n), 1, 1), s["last"])
            return F.struct(i.alias("i"), n.alias("n"), text.alias("original"), F.concat(left, right).alias("sides"))
        return F.transform(F.sequence(F.lit(1), F.least(F.size(s["g"]) - i, F.lit(MAX_GROUPS))), of)

    def judged(c):
        kind = F.when(~c["sides"].contains("."), kind_of(c["original"]))
        kind = F.transform(F.array(kind), lambda k: F.when((k == "card") | ~c["sides"].contains("-"), k))[0]
        rank = F.when(kind != "card", 1).when(c["original"].rlike(f"^(?:{CARD_LAYOUT})$"), 0).otherwise(2)
        return F.struct(rank.alias("rank"), c["i"].alias("i"), (-c["n"]).alias("less"), c["n"].alias("n"),
                        kind.alias("kind"), c["original"].alias("original"))

    def taken(acc, c):
        clash = F.exists(acc, lambda f: (f["i"] < c["i"] + c["n"]) & (c["i"] < f["i"] + f["n"]))
        return F.when(clash, acc).otherwise(F.concat(acc, F.array(c)))

    def finish(s):
        every = F.flatten(F.transform(F.sequence(F.lit(0), F.size(s["g"]) - 1), lambda i: tried(s, i)))
        short = F.filter(every, lambda c: (F.size(s["g"]) == 1) | (F.length(_digits(c["original"])).between(4, MAX_GROUPS)))
        good = F.array_sort(F.filter(F.transform(short, judged), lambda c: c["kind"].isNotNull()))
        none = F.array().cast("array<struct<rank:int,i:int,less:int,n:int,kind:string,original:string>>")
        found = F.aggregate(good, none, taken)
        return F.struct(s["g"].alias("g"), s["last"].alias("last"), F.transform(
            F.array_sort(F.transform(found, lambda f: F.struct(f["i"].alias("i"), f["n"].alias("n"), f["kind"].alias("kind"),
                                                               f["original"].alias("original")))),
            lambda f: F.struct(f["i"].alias("i"), f["n"].alias("n"), f["kind"].alias("kind"), f["original"].alias("original"),
                               pseudonym(f["original"], f["kind"], key).alias("pseudonym"))).alias("f"))

    def written(s):
        def of(x, i):
            own = F.filter(s["f"], lambda f: (f["i"] <= i) & (i < f["i"] + f["n"]))
            new = F.when(F.get(own, F.lit(0))["i"] < i, "").otherwise(F.concat(
                F.when(i > 0, F.substring(x, 1, 1)).otherwise(""), F.get(own, F.lit(0))["pseudonym"]))
            return F.when(F.size(own) > 0, new).otherwise(x)
        return F.struct(F.transform(s["f"], lambda f: F.struct(f["kind"].alias("kind"), f["original"].alias("original"),
                                                               f["pseudonym"].alias("pseudonym"))).alias("found"),
                        F.concat(F.array_join(F.transform(s["g"], of), ""), s["last"]).alias("text"))

    # Arrays of one element: each step is computed once, however often it is used.
    start = F.array(F.struct(groups.alias("g"), last.alias("last")))
    return F.transform(F.transform(start, finish), written)[0]


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a validated match, in its own format."""
    d = _digits(m)
    # Card: all but the check digit, which is computed anew.
    n = F.length(d) - 1
    body = F.substring(d, F.lit(1), n).cast("bigint")
    half = F.floor(n / 2)
    card = _pad(feistel(body, F.pow(F.lit(10), n - half).cast("bigint"), F.pow(F.lit(10), half).cast("bigint"),
                        "card", key), n)
    check = (10 - luhn_sum(card, True) % 10) % 10
    card = _into(m, F.concat(card, check.cast("string")))
    # Phone: all 10**10 numbers. Area and exchange stay in 000-199 or 200-999,
    # so a number of the numbering plan stays one; line 0000-9999.
    ten = F.right(d, F.lit(10))
    area, exchange = F.substring(ten, 1, 3).cast("bigint"), F.substring(ten, 4, 3).cast("bigint")
    def low(x):
        return F.when(x < 200, 0).otherwise(200)
    def n_of(x):
        return F.when(x < 200, 200).otherwise(800)
    lines = n_of(exchange) * 10000
    number = (area - low(area)) * lines + (exchange - low(exchange)) * 10000 + F.substring(ten, 7, 4).cast("bigint")
    p = feistel(number, n_of(area) * 100, n_of(exchange) * 100, "phone", key)
    phone = _into(m, F.concat(F.when(F.length(d) > 10, F.substring(d, 1, 1)).otherwise(""),
                              _pad(F.floor(p / lines) + low(area), 3),
                              _pad(F.floor(F.pmod(p, lines) / 10000) + low(exchange), 3),
                              _pad(F.pmod(p, F.lit(10000)), 4)))
    # Social security number: 898 areas, 99 groups, 9999 serials.
    area = F.substring(d, 1, 3).cast("bigint")
    s = feistel((area - F.when(area > 666, 2).otherwise(1)) * (99 * 9999)
                + (F.substring(d, 4, 2).cast("bigint") - 1) * 9999 + F.substring(d, 6, 4).cast("bigint") - 1,
                F.lit(898), F.lit(99 * 9999), "ssn", key)
    new_area = F.floor(s / (99 * 9999)) + 1
    rest = F.pmod(s, F.lit(99 * 9999))
    ssn = F.concat_ws("-", _pad(F.when(new_area >= 666, new_area + 1).otherwise(new_area), 3),
                      _pad(F.floor(rest / 9999) + 1, 2), _pad(F.pmod(rest, F.lit(9999)) + 1, 4))
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("bigint"))
    i = feistel(F.aggregate(o, F.lit(0).cast("bigint"), lambda acc, x: acc * 256 + x),
                F.lit(65536), F.lit(65536), "ip", key)
    ip = F.concat_ws(".", *[F.pmod(F.shiftright(i, shift), F.lit(256)).cast("string") for shift in (24, 16, 8, 0)])
    days = F.datediff(F.try_to_date(m, "yyyy-MM-dd"), F.to_date(F.lit(ERA_START))).cast("bigint")
    size = ERA_SIDE * ERA_SIDE
    era = F.floor(days / size) * size
    start = F.greatest(era, F.lit(FIRST_DAY))
    own = F.least(era + size, F.lit(LAST_DAY + 1)) - start
    # The eras at both ends are cut short: their days are shifted by a keyed number.
    shift = _round(key, "date-shift", F.lit(0), era, own)
    new_day = start + F.when(own == size, feistel(F.pmod(days, F.lit(size)), F.lit(ERA_SIDE), F.lit(ERA_SIDE), "date", key)) \
        .otherwise(F.pmod(days - start + shift, own))
    date = F.date_format(F.date_add(F.to_date(F.lit(ERA_START)), new_day.cast("int")), "yyyy-MM-dd")
    email = F.concat(F.lit("user"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256),
                                                1, 16), F.lit("@example.invalid"))
    return (F.when(kind == "card", card).when(kind == "phone", phone).when(kind == "ssn", ssn)
            .when(kind == "ip", ip).when(kind == "date", date).when(kind == "email", email)
            .when(kind == "secret", F.lit("[SECRET]")).otherwise(m))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with a struct column ``out``: text (pseudonyms in place), found
    (array of kind, original, pseudonym in text order).

    One row out for each row in, equal rows alike; null text stays null and
    finds nothing, an empty table gives no rows; other columns are untouched,
    whatever their names. Matches that do not validate stay as they are. Long
    texts are taken whole. A text without a digit, ``@`` or secret's name skips
    the work. ``key`` is the secret of the permutation and has no default:
    whoever holds it can compute the mapping.
    """
    text, matches, done = F.col(text_col), "_m", "_f"
    while {matches, done} & set(docs.columns):
        matches, done = matches + "_", done + "_"
    hint = F.coalesce(text.rlike(HINT), F.lit(False))
    cut = docs.withColumn(matches, F.when(hint, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))))
    cut = cut.withColumn(done, F.when(F.size(matches) > 0, F.transform(matches, lambda m: values(m, key))))
    parts = F.split(text, PATTERN, -1)
    new = F.array_join(F.zip_with(parts, F.concat(F.transform(done, lambda x: x["text"]), F.array(F.lit(""))),
                                  lambda a, b: F.concat(a, b)), "")
    found = F.coalesce(F.flatten(F.transform(done, lambda x: x["found"])),
                       F.array().cast("array<struct<kind:string,original:string,pseudonym:string>>"))
    return (cut.withColumn(out, F.struct(F.when(F.col(done).isNull(), text).otherwise(new).alias("text"),
                                         found.alias("found"))).drop(matches, done))
