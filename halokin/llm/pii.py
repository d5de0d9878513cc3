"""Format-preserving pseudonyms for personal data (operator 2).

Candidates have a pattern for each kind and are validated: payment cards by the Luhn digit,
IBANs by their country's length and their remainder mod 97, social security numbers by their
excluded ranges, IPv4 addresses by their octets, dates by the calendar, phone numbers by their
digit count (bare ones as 3-3-4 digits). Cards and IBANs are tried at every start, also inside
candidates that fail, and the valid ones are marked; then one scan takes the leftmost first, and a
phone number of free length ends before a mark. Of valid values that overlap the leftmost stands.
A valid value is mapped by a keyed Feistel network within its own format, a
permutation: equal values get equal pseudonyms in all documents, different values
different ones, check digits are right again, and ``decrypt=True`` undoes it (but where the
digits of a neighbour and a card's pseudonym happen to form a valid card, one in ten for each
such reading, the text is read differently; ``pii`` has every value).

* card, SSN, phone: the digits in two halves, mod 10**k each; separators stay. A card
  keeps its length and gets a new Luhn digit; an SSN keeps the area, so that it stays
  valid; a phone number keeps its country code (and area code if it has 10 digits).
* IBAN: the digits behind the check digits; letters stay; new check digits.
* IPv4: two 16-bit halves. Its octets stay octets.
* date (``YYYY-MM-DD``, ``DD.MM.YYYY``, ``DD/MM/YYYY`` or, if that is no date,
  ``MM/DD/YYYY``, years 1800 to 2199): the day within these 400 years, which have
  146097 = 189 * 773 days, as a pair mod 189 and mod 773. A slash date that reads
  both ways is taken as day first; the pseudonym is always written day first, so one
  day has one pseudonym however it is written.
* e-mail: the letters and digits of the name, each within its own class; the domain stays.

Everything is SQL functions. The round function is SHA-256 over key, format, round
and the other half.

Defined results: null text stays null with zero counts; text without a valid value
stays as it is. A candidate that fails validation is left alone. Rows are
independent of each other, so repeats and ties get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import set_aside

#: Marks the places where a valid card or IBAN starts, within a text; it and ESCAPE are escaped in texts that hold them.
MARK, ESCAPE = "\ufdd0", "\ufdd1"
#: Length of an IBAN by country code.
IBAN_LENGTHS = {
    15: "NO", 16: "BE BI", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK ST TN VG",
    25: "AO CV GW LY MZ PT", 26: "IR IS TR", 27: "BF CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban_pattern() -> str:
    """Of the length of its country; other lengths and codes by the longest run of blocks."""
    fixed = [rf"(?:{'|'.join(codes.split())})[0-9]{{2}}(?: ?~[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf" ?~[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
             for n, codes in IBAN_LENGTHS.items()]
    return rf"(?:{'|'.join(fixed)}|[A-Z]{{2}}[0-9]{{2}}(?: ?~[A-Z0-9]{{4}}){{2,7}}(?: ?~[A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])"


_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: Patterns of the candidates, in the order in which they are tried. ``~``: a mark may stand here.
_TEMPLATES = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+~-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": _iban_pattern(),
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.~[0-9]{4}|[0-9]{2}/[0-9]{2}/~[0-9]{4})(?![0-9])",
    "ssn": r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-~(?!0000)[0-9]{4}(?![0-9])",
    "ip": rf"{_OCTET}(?:\.{_OCTET}){{3}}(?![0-9])",
    # in brackets, or +1 and ten digits, or + and up to 15 digits, or bare 3-3-4
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?~[0-9]{3,4}(?![0-9])"
             r"|\+1(?:[ .-]?[0-9]){10}(?![0-9])|\+[0-9](?:[ .-]?[0-9]){6,14}(?![0-9])"
             r"|[0-9]{3}(?:-[0-9]{3}-|\.[0-9]{3}\.| [0-9]{3} )~[0-9]{4}(?![0-9])",
    "card": r"[0-9]{4}(?:[ -]?~[0-9]{4}){2}[ -]?~[0-9]{1,7}(?![0-9])|[0-9]{4}[ -]?~[0-9]{6}[ -]?~[0-9]{5}(?![0-9])",
}
PATTERNS = {k: p.replace("~", "") for k, p in _TEMPLATES.items()}
#: What may stand before a candidate; numbers may also follow a hyphen behind a digit.
_WORD_EDGE, _DIGIT_EDGE = r"(?<![A-Za-z0-9_.+-])", r"(?<![A-Za-z0-9_.+])(?<![^0-9]-)"
_EDGES = {k: _WORD_EDGE if k in ("email", "iban", "ip") else _DIGIT_EDGE for k in PATTERNS}
#: The kinds whose candidates may overlap: they are tried at every start, and the valid ones marked.
CHECKED = ("iban", "card")
STARTS = "|".join(f"{_EDGES[k]}(?={PATTERNS[k]})" for k in CHECKED)
#: No candidate that is tried is longer, or has more starts inside it.
LONGEST, MOST_STARTS = 44, 12


def _scanned(kind: str) -> str:
    p = _TEMPLATES[kind].replace("~", MARK if kind == "email" else MARK + "?")
    return f"{_EDGES[kind]}{MARK}{'' if kind in CHECKED else '?'}(?:{p})"


CANDIDATE = "|".join(_scanned(k) for k in PATTERNS)
KINDS = tuple(PATTERNS)
ROUNDS = 8
#: A day pair within 1800-01-01 .. 2199-12-31.
FIRST_DAY, DAYS_A, DAYS_B = "1800-01-01", 189, 773


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _prf(key: str, kind: Column, i: Column, half: Column) -> Column:
    """60 pseudo-random bits."""
    said = F.concat_ws("|", F.lit(key), kind, i.cast("string"), half.cast("string"), F.lit(key))
    return F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("long")


def feistel(a: Column, b: Column, mod_a: Column, mod_b: Column, key: str, kind: Column, decrypt: bool = False) -> Column:
    """Struct (a, b): the pair permuted within mod_a x mod_b. Odd rounds change a by b, even ones b by a."""
    order = F.sequence(F.lit(1), F.lit(ROUNDS)) if not decrypt else F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1))
    sign = F.lit(-1 if decrypt else 1)

    def step(s: Column, i: Column) -> Column:
        odd = i % 2 == 1
        new_a = F.when(odd, F.pmod(s["a"] + sign * F.pmod(_prf(key, kind, i, s["b"]), mod_a), mod_a)).otherwise(s["a"])
        new_b = F.when(~odd, F.pmod(s["b"] + sign * F.pmod(_prf(key, kind, i, s["a"]), mod_b), mod_b)).otherwise(s["b"])
        return F.struct(new_a.alias("a"), new_b.alias("b"))

    return F.aggregate(order, F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def _pow10(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def _digits(d: Column, key: str, kind: Column, decrypt: bool) -> Column:
    """A string of 2 to 34 digits, permuted among those of its length; shorter ones stay."""
    left = F.floor(F.length(d) / 2).cast("int")
    right = F.length(d) - left
    return F.when(F.length(d) >= 2, _let(
        feistel(F.substring(d, F.lit(1), left), F.substring(d, left + 1, right), _pow10(left), _pow10(right), key,
                F.concat(kind, F.length(d).cast("string")), decrypt),
        lambda s: F.concat(F.lpad(s["a"].cast("string"), left, "0"), F.lpad(s["b"].cast("string"), right, "0")),
    )).otherwise(d)


def _refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, in order, by those of ``digits``."""
    chars = F.split(form, "")
    return F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("[0-9]"), F.substring(
        digits, F.length(F.regexp_replace(F.substring(form, F.lit(1), i + 1), "[^0-9]", "")), F.lit(1))).otherwise(c)), "")


def _only_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn_sum(d: Column) -> Column:
    """Luhn sum of a digit string whose last digit counts once."""
    n = F.length(d)

    def add(s: Column, i: Column) -> Column:
        x = F.substring(d, i, F.lit(1)).cast("int")
        twice = x * 2
        return s + F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _mod97(s: Column) -> Column:
    """Remainder of an alphanumeric string read with A = 10 .. Z = 35."""
    def add(acc: Column, c: Column) -> Column:
        v = F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return F.pmod(acc * F.when(v > 9, 100).otherwise(10) + v, F.lit(97))

    return F.aggregate(F.filter(F.split(s, ""), lambda c: c != ""), F.lit(0), add)


def _date_parts(m: Column) -> tuple[Column, Column]:
    """(layout, ISO text or null). A slash date is day first unless only month first is a date."""
    y_first = m.rlike("^[0-9]{4}-")
    day_first = F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2))
    month_first = F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2))
    is_date = lambda x: F.try_to_date(x, "yyyy-MM-dd").isNotNull()
    layout = (F.when(y_first, F.when(is_date(m), "ymd")).when(is_date(day_first), "dmy")
              .when(m.rlike("/") & is_date(month_first), "mdy"))
    return layout, F.when(layout == "ymd", m).when(layout == "dmy", day_first).when(layout == "mdy", month_first)


def kind_of(m: Column) -> Column:
    """The kind of a candidate; null if no kind's validation holds."""
    d = _only_digits(m)
    full = {k: m.rlike(f"^(?:{p})$") for k, p in PATTERNS.items()}
    compact = F.regexp_replace(m, " ", "")
    iban = full["iban"] & F.length(compact).between(15, 34) & (
        _mod97(F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))) == 1)
    year = F.substring(_date_parts(m)[1], 1, 4).cast("int")
    card = full["card"] & F.length(d).between(13, 19) & (_luhn_sum(d) % 10 == 0) & ~d.rlike("^0+$")
    return (F.when(full["email"], "email").when(iban, "iban")
            .when(full["date"] & F.coalesce(year.between(1800, 2199), F.lit(False)), "date")
            .when(full["ssn"], "ssn").when(full["ip"], "ip").when(full["phone"], "phone").when(card, "card"))


def _marked(text: Column) -> Column:
    """``text`` with a mark before every valid card or IBAN, also those that overlap others. What starts
    inside a candidate is tried as well, so one that fails hides nothing."""
    def judge(parts: Column) -> Column:
        def one(part: Column, i: Column) -> Column:
            ahead = F.substring(F.array_join(F.slice(parts, i + 1, F.lit(MOST_STARTS)), ""), 1, LONGEST)
            value = F.regexp_extract(ahead, f"^(?:{'|'.join(PATTERNS[k] for k in CHECKED)})", 0)
            return F.when(i == 0, part).when(_let(value, lambda m: kind_of(m).isin(*CHECKED)), F.concat(F.lit(MARK), part)).otherwise(part)

        return F.array_join(F.transform(parts, one), "")

    return F.when(text.rlike(STARTS), _let(F.split(F.regexp_replace(text, STARTS, MARK), MARK, -1), judge)).otherwise(text)


def _escaped(text: Column) -> Column:
    return F.when(text.rlike(f"[{MARK}{ESCAPE}]"), F.regexp_replace(F.regexp_replace(
        text, ESCAPE, ESCAPE + "\ufdd2"), MARK, ESCAPE + "\ufdd3")).otherwise(text)


def _unescaped(text: Column) -> Column:
    return F.when(text.rlike(ESCAPE), F.regexp_replace(F.regexp_replace(
        text, ESCAPE + "\ufdd3", MARK), ESCAPE + "\ufdd2", ESCAPE)).otherwise(text)


def _card(m: Column, key: str, decrypt: bool) -> Column:
    d = _only_digits(m)
    body = F.substring(d, F.lit(1), F.length(d) - 1)
    return _let(_digits(body, key, F.lit("card"), decrypt), lambda p: _refill(
        m, F.concat(p, F.pmod(-_luhn_sum(F.concat(p, F.lit("0"))), F.lit(10)).cast("string"))))


def _iban(m: Column, key: str, decrypt: bool) -> Column:
    tail = F.substring(m, F.lit(5), F.length(m))
    fresh = _let(_digits(_only_digits(tail), key, F.concat(F.lit("iban"), F.regexp_replace(m, "[0-9]", "0")), decrypt),
                 lambda p: _refill(tail, p))
    return _let(fresh, lambda t: F.concat(
        F.substring(m, 1, 2),
        F.lpad((F.lit(98) - _mod97(F.concat(F.regexp_replace(t, " ", ""), F.substring(m, 1, 2), F.lit("00")))).cast("string"), 2, "0"),
        t))


def _ip(m: Column, key: str, decrypt: bool) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    wide = F.lit(65536)
    return _let(o, lambda o: _let(
        feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], wide, wide, key, F.lit("ip"), decrypt),
        lambda s: F.concat_ws(".", *[x.cast("string") for h in ("a", "b") for x in (F.shiftright(s[h], 8), s[h] % 256)])))


def _phone(m: Column, key: str, decrypt: bool) -> Column:
    d = _only_digits(m)
    free = F.when(F.length(d) >= 10, 7).otherwise(F.length(d) - 3)
    keep = F.substring(d, F.lit(1), F.length(d) - free)
    tail = F.substring(d, F.length(d) - free + 1, free)
    return _refill(m, F.concat(keep, _digits(tail, key, F.concat(F.lit("phone"), keep), decrypt)))


def _ssn(m: Column, key: str, decrypt: bool) -> Column:
    """Area kept; group 01..99 and serial 0001..9999 permuted."""
    s = feistel(F.substring(m, 5, 2).cast("int") - 1, F.substring(m, 8, 4).cast("int") - 1, F.lit(99), F.lit(9999), key,
                F.concat(F.lit("ssn"), F.substring(m, 1, 3)), decrypt)
    return _let(s, lambda s: F.concat(F.substring(m, 1, 4), F.lpad((s["a"] + 1).cast("string"), 2, "0"), F.lit("-"),
                                      F.lpad((s["b"] + 1).cast("string"), 4, "0")))


def _date(m: Column, key: str, decrypt: bool) -> Column:
    """Slash dates are written day first, which is also how they are read again."""
    layout, iso = _date_parts(m)
    day = F.datediff(F.to_date(iso, "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date"))
    s = feistel(F.floor(day / DAYS_B), day % DAYS_B, F.lit(DAYS_A), F.lit(DAYS_B), key, F.lit("date"), decrypt)
    fresh = _let(s, lambda s: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (s["a"] * DAYS_B + s["b"]).cast("int")), "yyyy-MM-dd"))
    dmy = lambda x, sep: F.concat_ws(sep, F.substring(x, 9, 2), F.substring(x, 6, 2), F.substring(x, 1, 4))
    return _let(fresh, lambda x: F.when(layout == "ymd", x).when(m.rlike("/"), dmy(x, "/")).otherwise(dmy(x, ".")))


def _email(m: Column, key: str, decrypt: bool) -> Column:
    """A Feistel network over the two halves of the name; a character moves within its class."""
    name, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    half = F.ceil(F.length(name) / 2).cast("int")

    def moved(own: Column, other: Column, i: Column) -> Column:
        def one(c: Column, k: Column) -> Column:
            said = F.concat_ws("|", F.lit(key), F.lit("email"), i.cast("string"), F.floor(k / 16).cast("string"), other,
                               F.lower(domain), F.lit(key))
            shift = F.conv(F.substring(F.sha2(said, 256), ((k % 16) * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int") * (-1 if decrypt else 1)
            turn = lambda first, n: F.char(F.lit(first) + F.pmod(F.ascii(c) - first + shift, F.lit(n)))
            return F.when(c.rlike("[a-z]"), turn(97, 26)).when(c.rlike("[A-Z]"), turn(65, 26)).when(c.rlike("[0-9]"), turn(48, 10)).otherwise(c)

        return F.array_join(F.transform(F.filter(F.split(own, ""), lambda c: c != ""), one), "")

    def step(s: Column, i: Column) -> Column:
        return F.struct(F.when(i % 2 == 1, moved(s["a"], s["b"], i)).otherwise(s["a"]).alias("a"),
                        F.when(i % 2 == 0, moved(s["b"], s["a"], i)).otherwise(s["b"]).alias("b"))

    order = F.sequence(F.lit(1), F.lit(ROUNDS)) if not decrypt else F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1))
    start = F.struct(F.substring(name, F.lit(1), half).alias("a"), F.substring(name, half + 1, F.length(name)).alias("b"))
    return _let(F.aggregate(order, start, step), lambda s: F.concat(s["a"], s["b"], F.lit("@"), domain))


def pseudonym(m: Column, kind: Column, key: str, decrypt: bool = False) -> Column:
    """The pseudonym of one candidate of a known kind; itself if ``kind`` is null."""
    by = {"email": _email, "iban": _iban, "date": _date, "ssn": _ssn, "ip": _ip, "phone": _phone, "card": _card}
    out = m
    for k, f in by.items():
        out = F.when(kind == k, f(m, key, decrypt)).otherwise(out)
    return out


@set_aside("__found", "__marked")
def pseudonymise(docs: DataFrame, key: str, *, text_col: str = "text", decrypt: bool = False) -> DataFrame:
    """``docs`` with the text column replaced, and the columns ``pii`` (array of (kind, value, pseudonym), in
    text order, valid ones only) and ``n_<kind>`` for each kind added (existing ones of these names are replaced)."""
    text = F.col(text_col)
    # Most texts hold nothing like a candidate: a scan for one character class decides before the full patterns run.
    marked = F.when(text.rlike("[0-9]|@"), _marked(_escaped(text)))
    found = F.when(F.col("__marked").isNotNull(), F.regexp_extract_all("__marked", F.lit(CANDIDATE), F.lit(0)))
    bare = lambda t: F.regexp_replace(t, MARK, "")
    added = ["pii", *(f"n_{k}" for k in KINDS)]
    rest = docs.drop(*[c for c in added if c in docs.columns]).withColumn("__marked", marked)
    judged = rest.withColumn("__found", F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda x: _let(bare(x), lambda m: _let(
        kind_of(m), lambda k: F.struct(k.alias("kind"), m.alias("value"), pseudonym(m, k, key, decrypt).alias("pseudonym"))))))
    joined = F.array_join(F.zip_with(F.split("__marked", CANDIDATE, -1), F.col("__found"),
                                     lambda t, f: F.concat(bare(t), F.coalesce(f["pseudonym"], F.lit("")))), "")
    out = judged.withColumn(text_col, F.when(F.size("__found") > 0, _unescaped(joined)).otherwise(text))
    out = out.withColumn("pii", F.filter("__found", lambda x: x["kind"].isNotNull())).drop("__found", "__marked")
    count = lambda kind: F.size(F.filter("pii", lambda x: x["kind"] == kind))
    return out.withColumns({f"n_{k}": count(k) for k in KINDS})
