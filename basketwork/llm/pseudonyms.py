"""Format-preserving Feistel pseudonyms of personal numbers and dates, on built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketwork.llm.common import carried, let, restored

ROUNDS = 8
# Days from 1900-01-01 to 2099-12-31, as the product of the two digits that the network mixes.
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)

# The written forms that are looked for, in order of precedence.
FORMS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r'\bAKIA[A-Z0-9]{16}\b|\b(?i:password|token|secret|api_key) ?[=:] ?"?[A-Za-z0-9_-]{8,}"?',
    "date": r"(?<![0-9.-])(?:(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9]|[0-3]?[0-9]([./])[0-3]?[0-9]\1(?:19|20)[0-9]{2})(?![0-9]|[.-][0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"\+[0-9]{1,3}[ .-]?\([0-9]{1,4}\)[ .-]?[0-9]{2,4}[ .-]?[0-9]{2,4}(?![0-9])|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
    r"|(?<![0-9+-])(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9]|-[0-9])",
}
PATTERN = "|".join(f"(?:{form})" for form in FORMS.values())
# A text without any of these holds none of the forms.
HINT = "[0-9@]|AKIA|(?i:password|token|secret|api_key) ?[=:]"


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _keyed(key: str, *parts: Column) -> Column:
    """128 hex digits of a keyed hash, nested so that no longer message can be hashed on."""
    inner = F.sha2(F.concat_ws("|", F.lit(key), *parts), 512)
    return F.sha2(F.concat_ws("|", F.lit(key), inner), 512)


def _hex_number(hex_digits: Column, start: Column | int, length: int) -> Column:
    return F.conv(F.substr(hex_digits, F.lit(start), F.lit(length)), 16, 10).cast("long")


def permuted_number(value: Column, left: int, right: int, key: str, tweak: str) -> Column:
    """A keyed permutation of 0 .. left * right - 1: a Feistel network over the number's two digits."""

    def mix(own: Column, other: Column, size: int, i: Column) -> Column:
        mark = _hex_number(_keyed(key, F.lit(tweak), i.cast("string"), other.cast("string")), 1, 12)
        return F.pmod(own + F.pmod(mark, F.lit(size)), F.lit(size))

    def step(s: Column, i: Column) -> Column:
        left_turn = i % 2 == 0
        a = F.when(left_turn, mix(s["a"], s["b"], left, i)).otherwise(s["a"])
        b = F.when(left_turn, s["b"]).otherwise(mix(s["b"], s["a"], right, i))
        return F.struct(a.alias("a"), b.alias("b"))

    start = F.struct(F.floor(value / right).cast("long").alias("a"), F.pmod(value, F.lit(right)).cast("long").alias("b"))
    return F.aggregate(_rounds(), start, step, lambda s: s["a"] * right + s["b"])


def permuted_text(text: Column, key: str, tweak: str) -> Column:
    """A keyed permutation of the texts of one shape: digits stay digits, letters keep their case.

    A Feistel network over the two halves: each character of one half is moved round its
    alphabet by a keyed hash of the other half.
    """

    def move(half: Column, other: Column, i: Column) -> Column:
        def one(mark: Column) -> Column:
            def moved(c: Column, at: Column) -> Column:
                by = _hex_number(mark, F.pmod(at, F.lit(32)) * 4 + 1, 4)
                turned = lambda base, size: F.chr(F.pmod(F.ascii(c) - ord(base) + by, F.lit(size)) + ord(base))
                return (
                    F.when(c.between("0", "9"), turned("0", 10)).when(c.between("a", "z"), turned("a", 26))
                    .when(c.between("A", "Z"), turned("A", 26)).otherwise(c)
                )

            return F.array_join(F.transform(_characters(half), moved), "")

        return let(_keyed(key, F.lit(tweak), i.cast("string"), other), one)

    def step(s: Column, i: Column) -> Column:
        left_turn = i % 2 == 0
        a = F.when(left_turn, move(s["a"], s["b"], i)).otherwise(s["a"])
        b = F.when(left_turn, s["b"]).otherwise(move(s["b"], s["a"], i))
        return F.struct(a.alias("a"), b.alias("b"))

    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), half).alias("a"), F.substr(text, half + 1).alias("b"))
    return F.aggregate(_rounds(), start, step, lambda s: F.concat(s["a"], s["b"]))


def _rounds() -> Column:
    return F.array(*(F.lit(i) for i in range(ROUNDS)))


def _refilled(form: Column, digits: Column) -> Column:
    """`form` with its digits replaced in turn by `digits`."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(
            F.concat(s["out"], F.when(is_digit, F.substr(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + is_digit.cast("int")).alias("at"),
        )

    return F.aggregate(_characters(form), start, step, lambda s: s["out"])


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum; digits whose place from the right is `doubled` modulo 2 are doubled."""

    def share(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == doubled, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.transform(_characters(F.reverse(digits)), share), F.lit(0), lambda a, x: a + x)


def _email(m: Column, key: str) -> Column:
    return F.concat(permuted_text(F.substring_index(m, "@", 1), key, "email"), F.lit("@"), F.substring_index(m, "@", -1))


def _secret(m: Column, key: str) -> Column:
    head = F.regexp_extract(m, '^(?:AKIA|[A-Za-z_]+ ?[=:] ?"?)', 0)
    return F.concat(head, permuted_text(F.substr(m, F.length(head) + 1), key, "secret"))


def _date(m: Column, key: str) -> Column:
    """ISO, day.month.year or, where only that is a date, month/day/year; null if none."""
    iso = m.rlike("^[0-9]{4}-")
    mark = F.when(m.contains("/"), "/").otherwise(".")
    parts = F.when(iso, F.split(m, "-")).otherwise(F.split(m, "[./]"))

    def written(p: Column) -> Column:
        def day_of(year: Column, month: Column, day: Column) -> Column:
            whole = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
            return F.datediff(F.try_to_date(whole, "yyyy-MM-dd"), F.to_date(F.lit(FIRST_DAY)))

        def plain(number: Column, width: Column) -> Column:
            return F.when(width == 2, F.lpad(number.cast("string"), 2, "0")).otherwise(number.cast("string"))

        def render(order: str):
            def out(days: Column) -> Column:
                new = F.date_add(F.to_date(F.lit(FIRST_DAY)), permuted_number(days, *DAYS, key, "date").cast("int"))
                first, second = (F.dayofmonth(new), F.month(new)) if order == "dm" else (F.month(new), F.dayofmonth(new))
                if order == "iso":
                    return F.date_format(new, "yyyy-MM-dd")
                return F.concat(plain(first, F.length(p[0])), mark, plain(second, F.length(p[1])), mark, F.year(new).cast("string"))

            return out

        by = {"iso": (p[0], p[1], p[2]), "dm": (p[2], p[1], p[0]), "md": (p[2], p[0], p[1])}
        found = {o: day_of(*by[o]) for o in by}
        in_order = lambda o: let(found[o], render(o))
        return F.when(iso, in_order("iso")).when(found["dm"].isNotNull(), in_order("dm")).otherwise(in_order("md"))

    return let(parts, written)


def _ip(m: Column, key: str) -> Column:
    def out(o: Column) -> Column:
        value = F.aggregate(o, F.lit(0).cast("long"), lambda a, x: a * 256 + x)
        back = lambda v: F.concat_ws(".", *((F.shiftright(v, s) % 256).cast("string") for s in (24, 16, 8, 0)))
        return F.when(F.array_max(o) < 256, let(permuted_number(value, 65536, 65536, key, "ip"), back))

    return let(F.transform(F.split(m, "\\."), lambda x: x.cast("long")), out)


def _national_id(m: Column, key: str) -> Column:
    """US social security numbers: no area 000, 666 or 9xx, no group 00, no serial 0000."""

    def out(p: Column) -> Column:
        area, group, serial = p[0], p[1], p[2]
        number = (area - F.when(area > 666, 2).otherwise(1)) * (99 * 9999) + (group - 1) * 9999 + serial - 1
        valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)

        def back(v: Column) -> Column:
            a, rest = F.floor(v / (99 * 9999)), F.pmod(v, F.lit(99 * 9999))
            return F.format_string("%03d-%02d-%04d", a + F.when(a >= 665, 2).otherwise(1), F.floor(rest / 9999) + 1, F.pmod(rest, F.lit(9999)) + 1)

        return F.when(valid, let(permuted_number(number, 898, 99 * 9999, key, "national_id"), back))

    return let(F.transform(F.split(m, "-"), lambda x: x.cast("long")), out)


def _card(m: Column, key: str) -> Column:
    """Card numbers that pass the Luhn check: the first digit stays, the check digit is computed."""

    def out(d: Column) -> Column:
        body = F.concat(F.substr(d, F.lit(1), F.lit(1)), permuted_text(F.substr(d, F.lit(2), F.length(d) - 2), key, "card"))
        whole = let(body, lambda b: F.concat(b, F.pmod(10 - _luhn_sum(b, 0) % 10, F.lit(10)).cast("string")))
        return F.when(_luhn_sum(d, 1) % 10 == 0, _refilled(m, whole))

    return let(_digits(m), out)


def _phone(m: Column, key: str) -> Column:
    """The country code and the first digit after it stay; other digits depend on the national number alone."""
    code = F.length(F.regexp_extract(m, r"^\+([0-9]{1,3})(?=[ .(-])", 1))
    code = F.when(m.startswith("+") & (code == 0), 2).otherwise(code)

    def out(d: Column) -> Column:
        kept = code + 1
        digits = F.concat(F.substr(d, F.lit(1), kept), permuted_text(F.substr(d, kept + 1), key, "phone"))
        return F.when(F.length(d).between(7, 15), _refilled(m, digits))

    return let(_digits(m), out)


MAKERS = {"email": _email, "secret": _secret, "date": _date, "ip": _ip, "national_id": _national_id, "phone": _phone, "card": _card}


def pseudonym(match: Column, key: str) -> Column:
    """struct(kind, value): the pseudonym of a match; null kind and the match itself if it is not valid."""
    kind = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for name in reversed(FORMS):
        fits = match.rlike(f"^(?:{FORMS[name]})$")
        kind = F.when(fits, F.lit(name)).otherwise(kind)
        value = F.when(fits, MAKERS[name](match, key)).otherwise(value)
    return let(value, lambda v: F.struct(F.when(v.isNotNull(), kind).alias("kind"), F.coalesce(v, match).alias("value")))


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """`docs` with personal values in text replaced, and pii_kinds: the kind of each replaced value, in order.

    Looked for are e-mail addresses (the local part), access keys and assigned passwords, dates,
    IPv4 addresses, US social security numbers, telephone numbers and card numbers. Dates must
    exist and lie in 1900-2099, octets be below 256, cards pass the Luhn check; what fails is
    left as it is. Each value is permuted among the values of its format by a Feistel network
    keyed by `key`, so equal values have equal pseudonyms in every document and different values
    have different ones; tables need no join and no shuffle. Null texts stay null and empty ones
    empty, with no kinds. Every row gives one row; a pii_kinds column of `docs` is replaced, other
    columns are kept; an empty table gives none.
    """
    text = F.col("text").cast("string")
    matches = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    hinted = text.rlike(HINT)
    rows = carried(docs, _text=text, _found=F.when(hinted, F.transform(matches, lambda m: pseudonym(m, key))))

    def joined(gaps: Column) -> Column:
        pairs = F.zip_with(gaps, F.col("_found"), lambda gap, f: F.concat(gap, F.coalesce(f["value"], F.lit(""))))
        return F.array_join(pairs, "")

    new = F.when(F.size("_found") > 0, joined(F.split("_text", PATTERN, -1))).otherwise(F.col("_text"))
    kinds = F.filter(F.transform("_found", lambda f: f["kind"]), lambda k: k.isNotNull())
    none = F.array().cast("array<string>")
    return restored(rows, docs, text=new, pii_kinds=F.coalesce(kinds, none))
