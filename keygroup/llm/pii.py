"""Format-preserving pseudonyms for personal data, in Spark's own functions.

Mail addresses, phone numbers, card numbers (Luhn), US social security numbers, IBANs
(mod 97), IPv4 addresses and dates are found by pattern and validated; what fails its
test is left alone. A valid value is permuted, within its format, by a keyed Feistel
network, and its check digits are made anew: the result is a valid value of the same
form. Equal values have equal pseudonyms in every document, different ones different.

A half of the network is a string of characters of one alphabet. A round adds to each
character of one half a number drawn from a keyed hash of the other half, modulo the
size of the alphabet; it can be undone by subtraction, so all rounds are a permutation.
Where only some strings of a length are valid (dates, social security numbers), the
network is applied until the result is valid, which is a permutation of the valid ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keygroup.llm.common import others
from keygroup.names import quoted

ROUNDS = 8
# Tries until a permuted value is valid again; one try in two, at worst, is not enough.
WALK = 400
DIGITS = "0123456789"
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyz"
# Letters that one round of a network draws numbers for, twice.
BLOCK = 64
# First and last letter of stretches that hold letters only, outside ASCII.
SCRIPTS = (
    (0xDF, 0xF6), (0xF8, 0xFF), (0x100, 0x17F), (0x180, 0x24F), (0x3B1, 0x3C9), (0x430, 0x45F), (0x561, 0x586),
    (0x5D0, 0x5EA), (0x620, 0x64A), (0x905, 0x939), (0xE01, 0xE30), (0x10D0, 0x10FA), (0x3041, 0x3096),
    (0x30A1, 0x30FA), (0x4E00, 0x9FEF), (0xAC00, 0xD7A3),
)
FIRST_DAY, DAYS = "1900-01-01", 73_049
SSN_AREAS = 898

KINDS = ("email", "iban", "ssn", "date", "phone", "card", "ip")
_MAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}(?![\p{L}\p{N}])"
_IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_DATE = r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-])"
_PHONE = (
    r"(?<![\d+])\+\d{1,3}[ .-]\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{4}(?!\d)"
    r"|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
)
_CARD = (
    r"(?<![\d.-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5}|\d{13,19})(?![\d-])"
)
_IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
PATTERN = "|".join((_MAIL, _IBAN, _SSN, _DATE, _PHONE, _CARD, _IP))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _at(value: Column, at: Column | int) -> Column:
    return F.substring(value, F.lit(at) if isinstance(at, int) else at, F.lit(1))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _each(value: Column, step) -> Column:
    """Joins ``step(i)`` for each place i of a text, counted from 1; empty for an empty one."""
    places = F.when(F.length(value) > 0, F.sequence(F.lit(1), F.length(value))).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, step), "")


def feistel(value: Column, key: str, tweak: str | Column, alphabet: str | Column = DIGITS) -> Column:
    """A keyed permutation of the texts of one length over ``alphabet`` (up to 64 characters)."""
    letters = F.lit(alphabet) if isinstance(alphabet, str) else alphabet
    half = F.floor(F.length(value) / 2).cast("int")
    state = F.struct(
        F.substring(value, F.lit(1), half).alias("a"),
        F.substring(value, half + 1, F.length(value) - half).alias("b"),
    )

    def turn(s: Column, i: Column) -> Column:
        seed = F.concat_ws("|", F.lit(key), F.lit(tweak), F.length(value).cast("string"), i.cast("string"), s["b"])

        def shifted(noise: Column, j: Column) -> Column:
            drawn = F.conv(F.substring(noise, 2 * j - 1, F.lit(2)), 16, 10).cast("int")
            old = F.position(_at(s["a"], j), letters) - 1
            return _at(letters, (old + drawn) % F.length(letters) + 1)

        noise = F.sha2(F.encode(seed, "utf-8"), 256)
        added = _let(noise, lambda n: _each(s["a"], lambda j: shifted(n, j)))
        return F.struct(s["b"].alias("a"), added.alias("b"))

    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, state, turn, lambda s: F.concat(s["a"], s["b"]))


def _filled(form: Column, characters: Column, kept: str = r"[^0-9]") -> Column:
    """``form`` with its characters outside ``kept`` replaced by ``characters``, in order."""

    def place(new: Column, i: Column) -> Column:
        own = _at(form, i)
        before = F.length(F.regexp_replace(F.substring(form, F.lit(1), i), kept, ""))
        return F.when(own.rlike(f"^{kept}$"), own).otherwise(_at(new, before))

    return _let(characters, lambda new: _each(form, lambda i: place(new, i)))


def _job(body: Column, tweak: str | Column, alphabet: str = DIGITS, rule: str | Column = "") -> Column:
    """A text to be permuted, under its tweak, until the result is valid by the rule."""
    return F.struct(
        body.alias("body"), F.lit(tweak).alias("tweak"), F.lit(alphabet).alias("alphabet"), F.lit(rule).alias("rule")
    )


def _permuted(job: Column, key: str) -> Column:
    """The permuted text of a job: the one place where the network stands in a plan.

    Where only some texts are valid, the network goes on from its result until it is,
    which is a permutation of the valid ones. Should ``WALK`` tries not do, that is an error.
    """

    def valid(d: Column) -> Column:
        n = d.cast("bigint")
        return (
            F.when(job["rule"] == "ssn", n < SSN_AREAS * 99 * 9999)
            .when(job["rule"] == "date", n < DAYS)
            # The result keeps its day above 12, lest it be the same as the result of another date.
            .when(job["rule"] == "months first", (n < DAYS) & (F.day(_from_day(n)) > 12))
            .otherwise(F.lit(True))
        )

    def step(s: Column, _: Column) -> Column:
        further = _let(
            feistel(s["d"], key, job["tweak"], job["alphabet"]), lambda d: F.struct(d.alias("d"), valid(d).alias("done"))
        )
        return F.when(s["done"], s).otherwise(further)

    tries = F.sequence(F.lit(1), F.when(job["rule"] == "", 1).otherwise(WALK))
    start = F.struct(job["body"].alias("d"), F.lit(False).alias("done"))
    failed = F.raise_error(F.lit("no valid pseudonym was found"))
    return F.aggregate(tries, start, step, lambda s: F.when(s["done"], s["d"]).otherwise(failed))


# -- kinds ------------------------------------------------------------------------


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled and its digits added."""

    def add(total: Column, i: Column) -> Column:
        d = _at(digits, F.length(digits) - i + 1).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _card_body(value: Column) -> Column:
    digits = _digits(value)
    return F.substring(digits, F.lit(1), F.length(digits) - 1)


def _card(value: Column, moved: Column) -> Column:
    check = (10 - luhn_sum(F.concat(moved, F.lit("0"))) % 10) % 10
    return _filled(value, F.concat(moved, check.cast("string")))


def iban_rest(value: Column) -> Column:
    """The remainder by 97 of an IBAN without spaces; 1 if it is valid."""
    moved = F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        v = F.position(F.lower(_at(moved, i)), F.lit(ALPHABET)) - 1
        return F.when(v > 9, rest * 100 + v).otherwise(rest * 10 + v) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add)


def _account(value: Column) -> Column:
    plain = F.regexp_replace(value, " ", "")
    return F.substring(plain, F.lit(5), F.length(plain))


def _iban(value: Column, moved: Column) -> Column:
    country = F.substring(value, 1, 2)

    def checked(a: Column) -> Column:
        check = F.lpad((98 - iban_rest(F.concat(country, F.lit("00"), a))).cast("string"), 2, "0")
        return F.concat(country, check, a)

    return _filled(value, _let(_filled(_account(value), moved), checked), " ")


def _country(value: Column) -> Column:
    return F.regexp_extract(value, r"^\+\d{1,3}", 0)


def _behind_country(value: Column) -> Column:
    return F.substring(value, F.length(_country(value)) + 1, F.length(value))


def _phone(value: Column, moved: Column) -> Column:
    return F.concat(_country(value), _filled(_behind_country(value), moved))


_KEPT = r"[^0-9a-z]"


def _mail_parts(value: Column) -> Column:
    """Name and domain of an address, without its last label, which stays."""
    lower = F.lower(value)
    top = F.regexp_extract(lower, r"\.[^.]*$", 0)
    name = F.substring_index(lower, "@", 1)
    domain = F.substring(lower, F.length(name) + 1, F.length(lower) - F.length(name) - F.length(top))
    return F.array(
        F.struct(name.alias("text"), F.lit("mail").alias("tweak")), F.struct(domain.alias("text"), F.lit("domain").alias("tweak"))
    )


def _n_blocks(part: Column) -> Column:
    plain = F.regexp_replace(part["text"], _KEPT, "")
    return F.greatest(F.lit(1), F.ceil(F.length(plain) / BLOCK).cast("int"))


def _mail_jobs(value: Column) -> Column:
    """Letters and digits of either part, in blocks; a later block is keyed by those before it."""

    def blocks(part: Column) -> Column:
        far = F.regexp_replace(part["text"], r"[\x00-\x7F]", "")
        own = F.when(far == "", part["tweak"]).otherwise(F.concat(part["tweak"], F.lit("|"), far))

        def block(plain: Column, i: Column) -> Column:
            chained = F.when(i == 0, own).otherwise(F.concat(own, F.lit("|"), F.substring(plain, F.lit(1), i * BLOCK)))
            return _job(F.substring(plain, i * BLOCK + 1, F.lit(BLOCK)), chained, ALPHABET)

        plain = F.regexp_replace(part["text"], _KEPT, "")
        places = F.sequence(F.lit(0), _n_blocks(part) - 1)
        return _let(plain, lambda p: F.transform(places, lambda i: block(p, i)))

    return F.flatten(F.transform(_mail_parts(value), blocks))


def _mail(value: Column, moved: Column, key: str) -> Column:
    """The address from its permuted blocks. Letters of ``SCRIPTS`` move within their own; the rest stay."""

    def rebuilt(parts: Column) -> Column:
        first = _n_blocks(parts[0])

        def part(p: Column, i: Column) -> Column:
            own = F.when(i == 0, F.slice(moved, 1, first)).otherwise(F.slice(moved, first + 1, F.size(moved)))
            shifted = F.when(p["text"].rlike(r"^[\x00-\x7F]*$"), p["text"]).otherwise(
                _each(p["text"], lambda j: _moved(p["text"], j, key, p["tweak"]))
            )
            return _filled(shifted, F.array_join(own, ""), _KEPT)

        return F.array_join(F.transform(parts, part), "")

    top = F.regexp_extract(F.lower(value), r"\.[^.]*$", 0)
    return F.concat(_let(_mail_parts(value), rebuilt), top)


def _moved(part: Column, i: Column, key: str, tweak: Column) -> Column:
    """The character at a place, shifted within its script by what stands before it outside ASCII."""
    own, before = _at(part, i), F.regexp_replace(F.substring(part, F.lit(1), i - 1), r"[\x00-\x7F]", "")
    seed = F.concat_ws("|", F.lit(key), F.concat(tweak, F.lit("-far")), i.cast("string"), before)
    drawn = F.conv(F.substring(F.sha2(F.encode(seed, "utf-8"), 256), 1, 8), 16, 10).cast("bigint")
    code, result = F.ascii(own), own
    for first, last in SCRIPTS:
        shifted = first + (code - first + drawn) % (last - first + 1)
        character = F.decode(F.unhex(F.lpad(F.hex(shifted), 4, "0")), "UTF-16BE")
        result = F.when(code.between(first, last), character).otherwise(result)
    return result


def _ssn_number(value: Column) -> Column:
    digits = _digits(value)
    area = F.substring(digits, 1, 3).cast("bigint")
    index = area - F.when(area > 666, 2).otherwise(1)
    index = (index * 99 + F.substring(digits, 4, 2).cast("bigint") - 1) * 9999 + F.substring(digits, 6, 4).cast("bigint") - 1
    return F.lpad(index.cast("string"), 9, "0")


def _ssn(moved: Column) -> Column:
    def written(n: Column) -> Column:
        area = F.floor(n / (99 * 9999)).cast("bigint")
        area = area + F.when(area >= 665, 2).otherwise(1)
        group, serial = F.floor(n / 9999).cast("bigint") % 99 + 1, n % 9999 + 1
        return F.format_string("%03d-%02d-%04d", area, group, serial)

    return _let(moved.cast("bigint"), written)


def _date_form(value: Column) -> Column:
    """The format under which a date is valid, or null; day before month where both fit."""
    forms = (r"^\d{4}-", "yyyy-MM-dd"), (r"^\d{2}/", "dd/MM/yyyy"), (r"^\d{2}/", "MM/dd/yyyy"), (r"^\d{2}\.", "dd.MM.yyyy")
    return F.coalesce(
        *(F.when(value.rlike(start) & _day(value, form).between(0, DAYS - 1), F.lit(form)) for start, form in forms)
    )


def _day(value: Column, form: str | Column) -> Column:
    return F.datediff(F.try_to_timestamp(value, F.lit(form)).cast("date"), F.lit(FIRST_DAY).cast("date"))


def _from_day(day: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), day.cast("int"))


def _date_job(value: Column) -> Column:
    def job(form: Column) -> Column:
        rule = F.when(form.startswith("MM"), "months first").otherwise("date")
        return _job(F.lpad(_day(value, form).cast("string"), 5, "0"), F.substring(form, 1, 2), DIGITS, rule)

    return _let(_date_form(value), job)


def _date(value: Column, moved: Column) -> Column:
    return F.call_function("date_format", _from_day(moved.cast("bigint")), _date_form(value))


def _ip_body(value: Column) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: F.lpad(F.hex(o.cast("bigint")), 2, "0"))
    return F.lower(F.array_join(octets, ""))


def _ip(moved: Column) -> Column:
    octet = lambda i: F.conv(F.substring(moved, 2 * i + 1, F.lit(2)), 16, 10)
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), octet), ".")


def kind_of(value: Column) -> Column:
    """The kind of a match of ``PATTERN``, or null if it fails the test of its kind."""
    digits = _digits(value)
    octets = F.split(value, r"\.")
    valid_ssn = ~value.rlike(r"^(000|666|9)|-00-|-0000$")
    # Digits alone first, so that no test meets a value of another kind.
    return (
        F.when(value.contains("@"), F.lit("email"))
        .when(value.rlike("^[A-Z]"), F.when(iban_rest(F.regexp_replace(value, " ", "")) == 1, F.lit("iban")))
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.when(valid_ssn, F.lit("ssn")))
        .when(value.rlike(r"^(\d{4}-\d{2}-\d{2}|\d{2}[/.]\d{2}[/.]\d{4})$"), F.when(_date_form(value).isNotNull(), F.lit("date")))
        .when(value.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), F.when(F.forall(octets, lambda o: o.cast("int") < 256), F.lit("ip")))
        .when(value.rlike(r"^[+(]") | value.rlike(r"^\d{3}[.-]\d{3}[.-]\d{4}$"), F.lit("phone"))
        .when((luhn_sum(digits) % 10 == 0) & ~digits.rlike("^0+$"), F.lit("card"))
    )


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a match of ``kind``; the match itself where that is null.

    What is to be permuted is laid out first, for whatever kind, then permuted, and then
    the value is written anew in its form.
    """
    jobs = (
        F.when(kind == "email", _mail_jobs(value))
        .when(kind == "iban", F.array(_job(_digits(_account(value)), "iban")))
        .when(kind == "ssn", F.array(_job(_ssn_number(value), "ssn", rule="ssn")))
        .when(kind == "date", F.array(_date_job(value)))
        .when(kind == "phone", F.array(_job(_digits(_behind_country(value)), "phone")))
        .when(kind == "card", F.array(_job(_card_body(value), "card")))
        .when(kind == "ip", F.array(_job(_ip_body(value), "ip", ALPHABET[:16])))
    )

    def written(moved: Column) -> Column:
        one = moved[0]
        return (
            F.when(kind == "email", _mail(value, moved, key))
            .when(kind == "iban", _iban(value, one))
            .when(kind == "ssn", _ssn(one))
            .when(kind == "date", _date(value, one))
            .when(kind == "phone", _phone(value, one))
            .when(kind == "card", _card(value, one))
            .when(kind == "ip", _ip(one))
        )

    return F.when(kind.isNull(), value).otherwise(_let(F.transform(jobs, lambda job: _permuted(job, key)), written))


ADDED = ("text", "found")


def pseudonymised(df: DataFrame, key: str, text_column: str = "text") -> DataFrame:
    """All rows with the text column rewritten, and ``found``: kind and pseudonym, in order.

    Null texts stay null and empty texts empty, with nothing found. Repeated rows are
    rewritten alike. Column order is kept; an input column named like the added one, in
    any case, is replaced. ``key`` decides the permutation; keep it secret.
    """
    text = F.col(quoted(text_column))
    keep = others(df, ["found"])
    matched = df.select(
        *(F.col(quoted(c)) for c in keep),
        F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).alias("_pii_found"),
    )
    told = F.transform("_pii_found", lambda m: F.struct(m.alias("own"), kind_of(m).alias("kind")))
    made = F.transform(
        told, lambda m: F.struct(m["kind"].alias("kind"), pseudonym(m["own"], m["kind"], key).alias("value"))
    )
    some = F.size("_pii_found") > 0
    ready = matched.withColumn("_pii_made", F.when(some, made))
    pieces = F.zip_with(
        F.split(text, PATTERN, -1), F.col("_pii_made")["value"], lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))
    )
    rewritten = F.when(F.col("_pii_made").isNotNull(), F.array_join(pieces, "")).otherwise(text)
    valid = F.filter(F.col("_pii_made"), lambda m: m["kind"].isNotNull())
    none = F.array().cast("array<struct<kind:string,value:string>>")
    return ready.select(
        *(rewritten.alias(c) if c == text_column else F.col(quoted(c)) for c in keep),
        F.coalesce(valid, none).alias("found"),
    )
