"""Format-preserving pseudonyms of personal data, in built-in column functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8
KEY = "pseudonyms-1"  # a default for tests; give a secret key

_EMAIL = r"[\p{L}\p{N}._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,6}+"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# Four numbers after a version word are a version, not an address.
_VERSION = r"(?<!(?i:\bv|\bver|\bversion|\brelease)[ .:]{0,2})"
_IP = rf"{_VERSION}{_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)"
_IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
_SOCIAL = r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\p{L}\p{N}]|-\d)"
_DATE = r"(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\p{L}\p{N}])"
_PHONE = (
    r"(?:\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}"
    r"|\(\d{3}\) ?\d{3}-\d{4}|\d{3}[-.]\d{3}[-.]\d{4})(?![\p{L}\p{N}])"
)
_CARD = (
    r"(?:\d{13,19}|\d{4}[ -]\d{6}[ -]\d{5}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7})(?![\p{L}\p{N}])"
)
# Groups that end in pairs, with a country or as ten national digits.
_PAIRS = (
    r"(?:\+\d{1,3}(?:[ .-]?\(0\)[ .-]?|[ .-])\d{1,4}(?:[ .-]\d{2,3}){1,2}(?:[ .-]\d{2}){2}"
    r"|0[1-9](?:[ .-]\d{2}){4})(?![\p{L}\p{N}])"
)
_PHONE = rf"(?:{_PAIRS}|{_PHONE})"

# What stands between the name of a secret and its value; \\ and quotes as in JSON.
_IS = r"\\?[\"']?\]?[ \t]{0,4}(?:[=:]{1,2}>?|=>)[ \t]{0,4}"
_TOKEN = rf"(?i:token|secret|api_key|apikey){_IS}"
_PASSWORD = rf"(?i:password|passwd|pwd){_IS}"
_SCHEME = r"(?i:bearer |basic )?"
# A quoted value ends at the next quote that is not escaped, on the same line.
_CLOSED = "|".join(
    rf"(?<=(?<!\\){q})(?:(?<={_PASSWORD}{q}{_SCHEME})(?=[^{q}])|(?<={_TOKEN}{q}{_SCHEME})(?=[^{q}\r\n]{{12}}))"
    rf"[^\r\n]+?(?<!(?<!\\)\\)(?={q})"
    for q in "\"'"
)
# Any other value ends at a blank, a quote or a separator.
_VALUE = r"[^\s\"'`,;&<>(){}\[\]|]"
_OPEN = (
    rf"(?:(?<={_PASSWORD}(?:\\?[\"'])?{_SCHEME})(?![=:>\\])(?={_VALUE})"
    rf"|(?<={_TOKEN}(?:\\?[\"'])?{_SCHEME})(?![=:>\\])(?={_VALUE}{{12}})){_VALUE}+(?<!\\)"
)
# The first look-behind is cheap and fails at nearly every place.
_SECRET = rf"(?<=[=:>][ \t]{{0,4}}\\?[\"']?{_SCHEME})(?:{_CLOSED}|{_OPEN})"
# A value begins where no letter, digit or underscore stands before it. Group 1 holds secrets.
PATTERN = (
    rf"(?<![\p{{L}}\p{{N}}_])(?:({_SECRET})|{_EMAIL}|(?<!\d\.){_IP}|{_DATE}"
    rf"|{_IBAN}|(?<!\d-){_SOCIAL}|{_PHONE}|{_CARD})"
)

# 400 years from here repeat the calendar; their number of days is 189 * 773.
_FIRST_DAY, _HIGH, _LOW = "1800-01-01", 189, 773


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _characters(text: Column, then: Callable[[Column, Column], Column]) -> Column:
    """Every character (with its place from 1) replaced by ``then``, in linear time."""
    return F.array_join(F.transform(F.split(text, ""), lambda c, j: then(c, j + 1)), "")


def _number(digest: Column, place, width: int = 4) -> Column:
    return F.conv(F.substring(digest, place, F.lit(width)), 16, 10).cast("int")


def _digest(key: str, kind: str, turn: Column, half: Column) -> Column:
    return F.sha2(
        F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), half.cast("string")), 512
    )


def _feistel(
    left: Column, right: Column, step: Callable[[Column, Column, Column, bool], Column]
) -> Column:
    """Rounds that change the halves in turn; ``step(half, other, turn, is_left)``."""
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        F.struct(left.alias("l"), right.alias("r")),
        lambda s, i: F.when(
            i % 2 == 0, F.struct(step(s["l"], s["r"], i, True).alias("l"), s["r"].alias("r"))
        ).otherwise(
            F.struct(s["l"].alias("l"), step(s["r"], s["l"], i, False).alias("r"))
        ),
    )


def permute_text(text: Column, kind: str, key: str) -> Column:
    """A keyed permutation of the texts of one shape.

    Digits become digits, small letters small, capitals capital; other characters
    keep their place. Each half is shifted by numbers drawn from the other half.
    """

    def shift(c: Column, by: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        first = F.when(digit, ord("0")).when(c >= "a", ord("a")).otherwise(ord("A"))
        turned = first + (F.ascii(c) - first + by) % F.when(digit, 10).otherwise(26)
        return F.when(c.rlike("^[0-9a-zA-Z]$"), F.char(turned)).otherwise(c)

    def step(half: Column, other: Column, i: Column, is_left: bool) -> Column:
        return _let(
            _digest(key, kind, i, other),
            lambda h: _characters(
                half, lambda c, j: shift(c, _number(h, ((j - 1) % 32) * 4 + 1))
            ),
        )

    cut = (F.length(text) / 2).cast("int")
    halves = _feistel(F.substring(text, F.lit(1), cut), F.substring(text, cut + 1, F.length(text)), step)
    return _let(halves, lambda s: F.concat(s["l"], s["r"]))


def _permute_number(
    value: Column, high: int, low: int, kind: str, key: str
) -> Column:
    """A keyed permutation of 0 .. high * low - 1."""
    halves = _feistel(
        F.floor(value / low).cast("int"),
        (value % low).cast("int"),
        lambda half, other, i, is_left: (
            half + _number(_digest(key, kind, i, other), F.lit(1), 6)
        ) % (high if is_left else low),
    )
    return _let(halves, lambda s: s["l"].cast("bigint") * low + s["r"])


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def _refill(shape: Column, new: Column, kept: str = "0-9") -> Column:
    """``shape`` with its characters of class ``kept`` replaced, in order, by ``new``."""
    return _let(
        new,
        lambda n: _characters(
            shape,
            lambda c, j: F.when(
                c.rlike(f"^[{kept}]$"),
                F.substring(
                    n,
                    F.length(F.regexp_replace(F.substring(shape, F.lit(1), j), f"[^{kept}]", "")),
                    F.lit(1),
                ),
            ).otherwise(c),
        ),
    )


def _luhn_sum(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add)


def _card(value: Column, key: str) -> Column:
    """All digits but the check digit are permuted, then the check digit is set."""

    def renew(digits: Column) -> Column:
        body = permute_text(F.substring(digits, F.lit(1), F.length(digits) - 1), "card", key)
        return _let(
            body,
            lambda b: F.concat(
                b, ((10 - _luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")
            ),
        )

    return _let(
        _only_digits(value),
        lambda d: F.when(_luhn_sum(d) % 10 == 0, _refill(value, renew(d))).otherwise(value),
    )


def _rest_97(text: Column) -> Column:
    """The number that digits and capitals (A is 10, Z is 35) spell, modulo 97."""

    def add(total: Column, c: Column) -> Column:
        return F.when(c.rlike("^[0-9]$"), (total * 10 + F.ascii(c) - 48) % 97).otherwise(
            (total * 100 + F.ascii(c) - 55) % 97
        )

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _iban(value: Column, key: str) -> Column:
    """The account is permuted, the country stays, the check digits are set.

    What only looks like one stays, but for a card number after its first group.
    """

    def renew(flat: Column) -> Column:
        country = F.substring(flat, F.lit(1), F.lit(2))
        return _let(
            permute_text(F.substring(flat, F.lit(5), F.length(flat)), "iban", key),
            lambda account: F.concat(
                country,
                F.lpad((98 - _rest_97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"),
                account,
            ),
        )

    turned = lambda flat: F.concat(F.substring(flat, F.lit(5), F.length(flat)), F.substring(flat, F.lit(1), F.lit(4)))
    card = F.substring(value, F.lit(6), F.length(value))
    return _let(
        F.replace(value, F.lit(" "), F.lit("")),
        lambda flat: F.when(
            F.length(flat).between(15, 34) & (_rest_97(turned(flat)) == 1),
            _refill(value, renew(flat), "A-Z0-9"),
        )
        .when(value.rlike(rf"^.{{4}} {_CARD}$"), F.concat(F.substring(value, F.lit(1), F.lit(5)), _card(card, key)))
        .otherwise(value),
    )


def _social(value: Column, key: str) -> Column:
    """A social security number, permuted among the valid ones (898 areas, 99 groups, 9999 serials)."""
    part = lambda n: F.element_at(F.split(value, "-"), n).try_cast("int")
    area = part(1) - F.when(part(1) > 666, 2).otherwise(1)
    number = (area.cast("bigint") * 99 + part(2) - 1) * 9999 + part(3) - 1

    def shown(n: Column) -> Column:
        high = F.floor(n / 9999)
        place = F.floor(high / 99)
        return F.format_string(
            "%03d-%02d-%04d", place + F.when(place >= 665, 2).otherwise(1), high % 99 + 1, n % 9999 + 1
        )

    return _let(_permute_number(number, 898 * 99, 9999, "social", key), shown)


def _phone(value: Column, key: str) -> Column:
    country = F.regexp_extract(value, r"^(\+(?:1|\d{2})(?=\D|\d{7})|)", 1)
    rest = F.substring(value, F.length(country) + 1, F.length(value))
    return F.concat(
        country,
        _let(rest, lambda r: _refill(r, permute_text(_only_digits(r), "phone", key))),
    )


def _email(value: Column, key: str) -> Column:
    local = F.substring_index(value, "@", 1)
    return F.concat(
        permute_text(local, "email", key), F.substring(value, F.length(local) + 1, F.length(value))
    )


def _address(value: Column, key: str) -> Column:
    """IPv4: the 32-bit number is permuted."""
    octet = lambda n: F.element_at(F.split(value, r"\."), n).cast("bigint")
    number = ((octet(1) * 256 + octet(2)) * 256 + octet(3)) * 256 + octet(4)
    return _let(
        _permute_number(number, 65536, 65536, "ip", key),
        lambda n: F.concat_ws(
            ".", *[(F.floor(n / 256**k) % 256).cast("int").cast("string") for k in (3, 2, 1, 0)]
        ),
    )


def _day(value: Column, pattern: str) -> Column:
    day = F.try_to_timestamp(value, F.lit(pattern)).cast("date")
    return F.when(F.year(day).between(1800, 2199), F.datediff(day, F.lit(_FIRST_DAY).cast("date")))


def _date(value: Column, key: str) -> Column:
    """The day is permuted within 1800-2199; the layout stays. No valid day, no change.

    Day before month is tried first. A date that only reads as month before day
    is permuted on until the result also reads only that way.
    """
    start = F.lit(_FIRST_DAY).cast("date")
    mark = F.substring(F.regexp_replace(value, r"[0-9]", ""), F.lit(1), F.lit(1))
    padded = F.length(value) == 10
    slashed = F.translate(value, ".", "/")

    def moved(day: Column) -> Column:
        return _permute_number(day, _HIGH, _LOW, "date", key).cast("int")

    def shown(day: Column, long: str, short: str) -> Column:
        at = F.date_add(start, day)
        text = F.when(padded, F.date_format(at, long)).otherwise(F.date_format(at, short))
        return F.replace(text, F.lit("/"), mark)

    def again(state: Column, _: Column) -> Column:
        done = F.dayofmonth(F.date_add(start, state)) > 12
        return F.when(done, state).otherwise(moved(state))

    iso, first, second = _day(value, "yyyy-MM-dd"), _day(slashed, "d/M/yyyy"), _day(slashed, "M/d/yyyy")
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(80)), moved(second), again)
    return (
        F.when(mark == "-", _let(iso, lambda d: F.date_format(F.date_add(start, moved(d)), "yyyy-MM-dd")))
        .when(first.isNotNull(), _let(first, lambda d: shown(moved(d), "dd/MM/yyyy", "d/M/yyyy")))
        .when(second.isNotNull(), _let(walked, lambda d: shown(d, "MM/dd/yyyy", "M/d/yyyy")))
    )


def pseudonym(value: Column, key: str = KEY) -> Column:
    """The pseudonym of one found value; invalid numbers and dates stay as they are."""
    new = (
        F.when(value.contains("@"), _email(value, key))
        .when(value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), _address(value, key))
        .when(value.rlike(rf"^{_DATE}$"), _date(value, key))
        .when(value.rlike(rf"^{_IBAN}$"), _iban(value, key))
        .when(value.rlike(rf"^{_SOCIAL}$"), _social(value, key))
        .when(value.rlike(rf"^{_PHONE}$"), _phone(value, key))
        .when(value.rlike(rf"^{_CARD}$"), _card(value, key))
        .otherwise(permute_text(value, "secret", key))
    )
    return F.coalesce(new, value)


def pseudonymise(
    documents: DataFrame, key: str = KEY, text: str = "text", name: str | None = None
) -> DataFrame:
    """``documents`` with personal data in ``text`` replaced by pseudonyms.

    E-mail addresses (the part before @), IPv4 addresses, dates, telephone
    numbers, card numbers and IBANs with right check digits, social security numbers
    and values of tokens and passwords are permuted within their format by a keyed Feistel network. A
    secret is taken whole, of any length: up to its closing quote, or without
    quotes up to a blank, quote or separator; its letters A-Z and digits change,
    the rest keeps its place. Tokens, secrets and API keys have at least 12
    characters, passwords one. Equal
    values get equal pseudonyms in every document, different ones different
    ones; all other text stays byte for byte. ``name``, if given, is a column for
    the number of values changed.

    Null texts stay null (0 changes), empty ones empty. Whole texts are read in
    one pass; the network runs only on what was found. Only built-in functions
    are used. Other columns and repeated rows stay; an empty table gives no rows.
    """
    old = F.col(text).cast("string")
    pattern = F.lit(PATTERN)
    # A secret may look like a date or a card, so what was found as one is marked.
    found = F.zip_with(
        F.regexp_extract_all(old, pattern, F.lit(0)),
        F.regexp_extract_all(old, pattern, F.lit(1)),
        lambda v, secret: F.struct(v.alias("v"), (secret != "").alias("secret")),
    )

    def hidden(x: Column) -> Column:
        return F.when(x["secret"], permute_text(x["v"], "secret", key)).otherwise(pseudonym(x["v"], key))

    values = F.transform(found, hidden)
    new = F.zip_with(
        F.split(old, PATTERN, -1), values, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))
    )
    changed = F.when(old.rlike(PATTERN), F.array_join(new, "")).otherwise(old)
    out = documents.withColumn(text, changed)
    if name is not None:
        moved = F.zip_with(found, values, lambda x, y: x["v"] != y)
        changes = F.size(F.filter(moved, lambda x: x))
        out = documents.withColumns(
            {text: changed, name: F.when(old.rlike(PATTERN), changes).otherwise(0)}
        )
    return out
