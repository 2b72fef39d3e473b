"""Format-preserving pseudonyms for personal data, in native expressions only.

Card, phone and social security numbers, IPv4 addresses and dates are validated and then
permuted by a keyed Feistel network within their own format: the pseudonym of a valid card
number is a valid card number, that of a date a date. The permutation depends on kind and
key only, so equal values have equal pseudonyms in all documents, different values have
different ones, and the holder of the key can turn them back (``reverse=True``). E-mail
addresses have no fixed format: they get a keyed name at a reserved domain, equal for equal
addresses (A-Z as a-z), which cannot be turned back.

A value ``x`` of a domain of ``a * b`` values is a pair (x div b, x mod b); rounds add a keyed
hash of one half to the other, modulo that half's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
#: Groups of two digits: a country code before, or a trunk zero ('06 12 34 56 78', '0470 12 34 56').
PAIRS = (
    r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?\d{1,3}(?:[ .-]\d\d){3,4}"
    r"|(?:00\d{1,3}[ .-](?:\(0\)[ .-]?)?\d|0\d)(?:[ .-]\d\d){4}|0\d{2,3}(?:[ .-]\d\d){3})(?!\w|-\d)"
)
PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w+])\+\d{8,15}(?!\d)"
ADDRESS = r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w)(?!\.\d)"
DATE = r"(?<!\w)(?:\d{4}-\d\d-\d\d(?=[Tt]\d)|\d{4}-\d\d-\d\d(?!\w)|(?:\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4})(?!\w))"
SOCIAL = r"(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-])"
#: No card begins or goes on where one of these begins.
OTHER = "|".join((DATE, SOCIAL, ADDRESS, PAIRS))
GROUP = r"\d++(?![\w@]|-(?!\d))"
#: All groups of digits with single blanks or hyphens between, 13 digits or more. Cards are parts of it.
RUN = rf"(?<![\w+-])(?<!\d\.\d{{1,3}}\.)(?!{OTHER})(?=\d(?:[ -]?\d){{12}}){GROUP}(?:[ -](?!{OTHER}){GROUP})*+"
#: Lengths of groups as printed on cards, each between 13 and 19 digits.
SHAPES = ("4-4-4-4", "4-6-5", "4-6-4", "4-4-4-4-3", "4-4-4-1", "4-3-3-3", "4-5-6", "8-8", "6-13")
#: Four groups of four that are no valid card are no telephone number either.
NO_CARD = r"(?<![\w-])\d{4}(?:[ -]\d{4}){3}(?![\w-])"
#: Numbers that look like telephone numbers: after "ISBN", with thousands apart, decimals, years.
NO_PHONE = "|".join((
    r"ISBN(?:-1[03])?:? ?\d[\d -]{8,15}[\dXx](?!\w)",
    r"(?<![\w+.,-])\d{1,3}(?:\.\d{3}){2,}(?!\w|\.\d|-\d)",
    r"(?<![\w+.,-])(?!0)\d{1,3}(?: \d{3})* 000(?: \d{3})*(?!\w|-\d| \d)",
    r"(?<![\w+.])\d{1,4}\.\d{5,}(?![\w.-])",
    r"(?<![\w+-])(?:19|20)\d\d(?:[ -](?:19|20)\d\d){2,}(?!\w|-\d)",
))
#: Earlier kinds win where two could begin at the same place. Cards have been cut out before.
PATTERN = "|".join((EMAIL, DATE, SOCIAL, ADDRESS, PAIRS, NO_CARD, NO_PHONE, PHONE))
#: Stands for a card, or for itself, while the text around is searched.
MARK = "\ue000"
#: Days from 1900-01-01 up to 2099-12-31: 73049 = 319 * 229.
FIRST_DAY, DAYS = "DATE'1900-01-01'", (319, 229)
#: Valid areas (001-899 without 666) times groups (01-99), and serial numbers (0001-9999).
SOCIAL_SIZES = (898 * 99, 9999)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def permuted(left: str, right: str, a: str, b: str, kind: str, key: str, reverse: bool = False) -> str:
    """SQL: struct ``l``, ``r``, the keyed permutation of (``left``, ``right``) in a * b values."""
    sign = "-" if reverse else "+"
    order = f"sequence({ROUNDS - 1}, 0, -1)" if reverse else f"sequence(0, {ROUNDS - 1})"
    mark = f"concat({_quoted(key)}, '|{kind}|', {a}, '|', {b}, '|', i, '|', {{}})"
    pick = f"CAST(conv(substr(sha2({mark}, 256), 1, 15), 16, 10) AS BIGINT)"
    return f"""aggregate({order},
        named_struct('l', CAST({left} AS BIGINT), 'r', CAST({right} AS BIGINT)),
        (s, i) -> IF(i % 2 = 0,
            named_struct('l', pmod(s.l {sign} {pick.format('s.r')} % CAST({a} AS BIGINT), CAST({a} AS BIGINT)), 'r', s.r),
            named_struct('l', s.l, 'r', pmod(s.r {sign} {pick.format('s.l')} % CAST({b} AS BIGINT), CAST({b} AS BIGINT)))))"""


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _digits(x: str, kind: str, key: str, reverse: bool) -> str:
    """SQL: the digit string ``x`` permuted among those of its length (two digits or more)."""
    u, v = f"CAST(length({x}) div 2 AS INT)", f"CAST(length({x}) - length({x}) div 2 AS INT)"
    size = lambda n: f"CAST(rpad('1', {n} + 1, '0') AS BIGINT)"
    found = permuted(f"substr({x}, 1, {u})", f"substr({x}, {u} + 1)", size(u), size(v), kind, key, reverse)
    return _let(found, "p", f"concat(lpad(p.l, {u}, '0'), lpad(p.r, {v}, '0'))")


def _refilled(x: str, digits: str) -> str:
    """SQL: ``x`` with its digits replaced in turn by those of ``digits``."""
    return _let(
        digits,
        "d",
        f"""aggregate(sequence(1, length({x})), named_struct('out', '', 'k', 0), (s, i) ->
            IF(substr({x}, i, 1) BETWEEN '0' AND '9',
               named_struct('out', concat(s.out, substr(d, s.k + 1, 1)), 'k', s.k + 1),
               named_struct('out', concat(s.out, substr({x}, i, 1)), 'k', s.k)), s -> s.out)""",
    )


def luhn_sum(digits: str, odd: int) -> str:
    """SQL: checksum of a digit string; digits at distance ``odd`` modulo 2 from the end are doubled."""
    return f"""aggregate(sequence(1, length({digits})), 0, (s, i) -> s + IF(
        (length({digits}) - i) % 2 = {odd},
        2 * CAST(substr({digits}, i, 1) AS INT) - IF(substr({digits}, i, 1) > '4', 9, 0),
        CAST(substr({digits}, i, 1) AS INT)))"""


def _card(x: str, key: str, reverse: bool) -> str:
    """The pseudonym of a card number ``x`` that passes the Luhn check."""
    body = _digits("substr(c, 1, length(c) - 1)", "card", key, reverse)
    check = f"concat(b, CAST((10 - {luhn_sum('b', 0)} % 10) % 10 AS STRING))"
    new = _let(body, "b", check)
    return _let(f"regexp_replace({x}, '[^0-9]', '')", "c", _refilled(x, new))


def _cards_of(run: str) -> str:
    """SQL: array of structs ``at``, ``n``: where ``run`` holds valid card numbers, in order.

    Candidates are all stretches of whole groups with 13 to 19 digits that pass the Luhn
    check. Where some overlap, one group alone goes first, then groups as printed on cards,
    then the longer and the earlier one. Pseudonyms keep the groups, so ``reverse`` finds the
    same stretches unless another of equal or better shape overlaps and passes by chance.
    """
    shapes = ", ".join(map(_quoted, SHAPES))
    groups = f"regexp_extract_all({run}, '[0-9]+', 0)"
    tried = f"""filter(flatten(transform(g, (one, i) -> transform(
            filter(sequence(1, least(19, size(g) - i)), k ->
                aggregate(slice(g, i + 1, k), 0, (t, h) -> t + length(h)) BETWEEN 13 AND 19),
            k -> named_struct('i', i, 'k', k, 'digits', array_join(slice(g, i + 1, k), ''))))),
        w -> {luhn_sum('w.digits', 1)} % 10 = 0)"""
    ranked = f"""array_sort(transform({tried}, w -> named_struct(
        'shape', CASE WHEN w.k = 1 THEN 0
            WHEN array_join(transform(slice(g, w.i + 1, w.k), h -> CAST(length(h) AS STRING)), '-') IN ({shapes}) THEN 1
            ELSE 2 END,
        'short', -length(w.digits), 'i', w.i, 'k', w.k)))"""
    chosen = f"""aggregate({ranked}, CAST(array() AS ARRAY<STRUCT<i: INT, k: INT>>), (got, w) ->
        IF(exists(got, o -> o.i < w.i + w.k AND w.i < o.i + o.k), got,
           concat(got, array(named_struct('i', w.i, 'k', w.k)))))"""
    spans = f"""transform(array_sort({chosen}), o -> named_struct(
        'at', IF(o.i = 0, 1, length(array_join(slice(g, 1, o.i), ' ')) + 2),
        'n', length(array_join(slice(g, o.i + 1, o.k), ' '))))"""
    return _let(groups, "g", spans)


def _cut(key: str, reverse: bool) -> tuple[str, str]:
    """SQL: of a match ``r`` of ``RUN`` or ``MARK``, the text with marks for cards, and what the marks stand for."""
    rest = f"""aggregate(spans, named_struct('out', '', 'from', 1), (s, o) -> named_struct(
            'out', concat(s.out, substr(r, s.from, o.at - s.from), '{MARK}'), 'from', o.at + o.n),
        s -> concat(s.out, substr(r, s.from)))"""
    cards = f"transform(spans, o -> {_let('substr(r, o.at, o.n)', 'v', _card('v', key, reverse))})"
    return rest, cards


def _phone(x: str, key: str, reverse: bool) -> str:
    """The country code (digits up to the first mark, else two) stays, and the trunk zero of pairs."""
    code = rf"""regexp_extract({x}, IF({x} RLIKE {_quoted('^(?:' + PAIRS + ')$')},
        '^((?:[+]\\d{{1,3}}(?!\\d)|00\\d{{1,3}}(?=[ .-](?:[(]0[)][ .-]?)?\\d[ .-])|[+]\\d\\d)(?:[ .-]?[(]0[)])?|0|)',
        '^([+]\\d{{1,3}}(?!\\d)|[+]\\d\\d|)'), 1)"""
    rest = f"substr({x}, length({code}) + 1)"
    number = f"regexp_replace({rest}, '[^0-9]', '')"
    new = _refilled(rest, _digits("n", "phone", key, reverse))
    return _let(number, "n", f"IF(length(n) BETWEEN 6 AND 15, concat({code}, {new}), NULL)")


def _address(x: str, key: str, reverse: bool) -> str:
    part = lambda k: f"CAST(element_at(split({x}, '[.]'), {k}) AS INT)"
    valid = " AND ".join(f"{part(k)} <= 255" for k in (1, 2, 3, 4))
    found = permuted(f"{part(1)} * 256 + {part(2)}", f"{part(3)} * 256 + {part(4)}", "65536", "65536", "ip", key, reverse)
    text = _let(found, "p", "concat_ws('.', p.l div 256, p.l % 256, p.r div 256, p.r % 256)")
    return f"IF({valid}, {text}, NULL)"


def _social(x: str, key: str, reverse: bool) -> str:
    area, group, serial = (f"CAST(substr({x}, {at}, {n}) AS INT)" for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = f"{area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0"
    left = f"({area} - IF({area} > 666, 2, 1)) * 99 + {group} - 1"
    found = permuted(left, f"{serial} - 1", *map(str, SOCIAL_SIZES), "social", key, reverse)
    at = "p.l div 99 + IF(p.l div 99 >= 665, 2, 1)"
    text = _let(found, "p", f"concat(lpad({at}, 3, '0'), '-', lpad(p.l % 99 + 1, 2, '0'), '-', lpad(p.r + 1, 4, '0'))")
    return f"IF({valid}, {text}, NULL)"


def _date(x: str, key: str, reverse: bool) -> str:
    """ISO, day.month.year or month/day/year; other orders and impossible days are no dates."""
    a, b = DAYS
    text = None
    for mark, shape in (("/", "MM/dd/yyyy"), (".", "dd.MM.yyyy"), ("-", "yyyy-MM-dd")):
        day = f"datediff(t, {FIRST_DAY})"
        found = permuted(f"{day} div {b}", f"{day} % {b}", str(a), str(b), "date", key, reverse)
        new = _let(found, "p", f"date_format(date_add({FIRST_DAY}, CAST(p.l * {b} + p.r AS INT)), '{shape}')")
        one = _let(
            f"CAST(try_to_timestamp({x}, '{shape}') AS DATE)",
            "t",
            f"IF(t BETWEEN {FIRST_DAY} AND DATE'2099-12-31', {new}, NULL)",
        )
        text = one if text is None else f"IF(contains({x}, '{mark}'), {one}, {text})"
    return text


def pseudonym(x: str, key: str, reverse: bool = False) -> str:
    """SQL: the pseudonym of a match ``x`` of ``PATTERN``, or null if it is not a valid value. Cards: ``_cards_of``."""
    email = "x" if reverse else (
        f"concat('p', substr(sha2(concat({_quoted(key)}, '|email|', lower(x)), 256), 1, 16), '@pseudonym.invalid')"
    )
    body = f"""CASE WHEN contains(x, '@') THEN {email}
        WHEN x RLIKE {_quoted('^(?:' + DATE + ')$')} THEN {_date('x', key, reverse)}
        WHEN x RLIKE {_quoted('^(?:' + SOCIAL + ')$')} THEN {_social('x', key, reverse)}
        WHEN x RLIKE {_quoted('^(?:' + ADDRESS + ')$')} THEN {_address('x', key, reverse)}
        WHEN x RLIKE {_quoted('^(?:' + NO_CARD + '|' + NO_PHONE + ')$')} THEN NULL
        ELSE {_phone('x', key, reverse)} END"""
    return body if x == "x" else _let(x, "x", body)


def pseudonymise(docs: DataFrame, key: str, reverse: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text`` with pseudonyms, ``n_found`` (replaced values).

    Text between the values stays as it is; candidates that fail validation stay too. A
    null text stays null and holds nothing. Other columns are ignored. No row is moved.
    """
    rest, cards = _cut(key, reverse)
    runs = _quoted(f"{RUN}|{MARK}")
    # First the cards: their runs are taken apart, and marks put in their place.
    found = docs.select(
        "doc_id",
        "text",
        F.expr(f"IF(text RLIKE '[0-9]' AND text RLIKE {runs}, regexp_extract_all(text, {_quoted('(' + RUN + '|' + MARK + ')')}, 0), NULL)").alias("runs"),
    )
    cut = found.select(
        "doc_id",
        "text",
        "runs",
        F.expr(f"""transform(runs, r -> IF(r = '{MARK}', named_struct('rest', r, 'cards', array(r)),
            {_let(_cards_of('r'), 'spans', f"named_struct('rest', {rest}, 'cards', {cards})")}))""").alias("cuts"),
    )
    # Then the other kinds, in what lies between the marks.
    parted = cut.select(
        "doc_id",
        "text",
        F.expr("flatten(transform(cuts, c -> c.cards))").alias("cards"),
        F.expr(f"""IF(size(cuts) > 0, split(array_join(transform(split(text, {runs}, -1), (part, i) ->
            concat(part, coalesce(get(cuts, i).rest, ''))), ''), '{MARK}', -1), array(text))""").alias("parts"),
    )
    marked = parted.select(
        "doc_id",
        "text",
        "cards",
        "parts",
        F.expr(f"""IF(text RLIKE '[0-9@]', transform(parts, part ->
            regexp_extract_all(part, {_quoted('(' + PATTERN + ')')}, 0)), NULL)""").alias("found"),
    )
    swapped = marked.select(
        "doc_id",
        "text",
        "cards",
        "parts",
        "found",
        F.expr(f"transform(found, xs -> transform(xs, x -> {pseudonym('x', key, reverse)}))").alias("fresh"),
    )
    between = f"""IF(size(xs) > 0, array_join(transform(split(get(parts, j), {_quoted(PATTERN)}, -1), (part, i) ->
        concat(part, coalesce(get(get(fresh, j), i), get(xs, i), ''))), ''), get(parts, j))"""
    joined = f"""IF(found IS NULL, text, array_join(transform(found, (xs, j) ->
        concat({between}, coalesce(get(cards, j), ''))), ''))"""
    return swapped.select(
        "doc_id",
        F.expr(joined).alias("text"),
        F.expr(f"""IF(found IS NULL, 0L, CAST(size(filter(flatten(fresh), f -> f IS NOT NULL))
            + IF(cards IS NULL, 0, size(filter(cards, c -> c <> '{MARK}'))) AS BIGINT))""").alias("n_found"),
    )
