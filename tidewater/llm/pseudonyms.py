"""Format-preserving pseudonyms by keyed Feistel networks, in DataFrame functions only.

Numbers, dates and names found in texts are replaced by others of the same format. A value is split into two parts of
fixed ranges; in each round one part is shifted by a keyed hash of the other, modulo its range. This permutes the
format's values, so equal values get equal pseudonyms in all documents, different ones stay different, and
``reveal`` with the same key gives the text back.

| kind | what counts as valid | what stays | range |
| --- | --- | --- | --- |
| card | 13 to 19 digits, Luhn sum | first digit, separators; the check digit is computed | the digits between |
| iban | country, check digits modulo 97, letters and digits | country, spaces; check digits are computed | letters for letters, digits for digits |
| ssn | area not 000, 666, 9xx; group, serial not 0 | hyphens | all valid numbers |
| phone | a country code and groups of digits, 8 to 15 in all, or ten digits grouped 3-3-4 | country code, punctuation | valid area and exchange codes, or all digits |
| ip | four octets up to 255 | dots | all addresses |
| date | a day of the calendar from 1800 to 2199, four orders | order, separators | the 88,497 days above 12 of 400 years, or the 57,600 others |
| email | a name and a domain with a dot | domain, punctuation, case | letters for letters, digits for digits |
| secret | 8 characters or more, up to white space or a quote, after a word like token or password | the word, punctuation, case | letters for letters, digits for digits |

What looks alike but is not valid is left as it is.

Cases: a NULL text stays NULL, an empty one empty. Overlapping candidates are taken from the left, in the order of the
alternatives. Very short parts (one letter) have few pseudonyms. Each row stands alone, so ties, repeated rows and empty
tables need no rule; other columns are passed on untouched, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KEY = "corpus-pseudonyms-1"  # the default of the registered query; pass a secret one

#: ASCII letters and digits, and the letters of other scripts below U+D800.
LETTER = "A-Za-z0-9\u00AA\u00B5\u00BA\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u02FF\u0300-\u1FFF\u2C00-\u2DFF\u3040-\uD7FF"
PHONE10 = r"\+[0-9]{1,3}[ -]?(?:\([0-9]{3}\)|[0-9]{3})[ -]?[0-9]{3}[ -]?[0-9]{4}"
PHONE_ANY = r"\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\)|[ .-][0-9]{1,5})(?:[ .-]?[0-9]{2,5}){1,5}|\+[0-9]{8,15}"
PHONE_PLAIN = r"(?<![0-9+.-])(?<![0-9] )(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
SECRET_BLOCK = 256  # secrets are replaced in blocks, so that time stays in proportion to their length

#: Alternatives in order. No group captures, so group 0 is the value.
PATTERNS = {
    "secret": r"(?i:(?:token|password|passwd|secret|api[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?[^\s\"']{8,})",
    "email": rf"(?<![{LETTER}._%+-])[{LETTER}][{LETTER}._%+-]{{0,63}}@(?:[A-Za-z0-9-]{{1,63}}\.){{1,8}}[A-Za-z]{{2,24}}",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4})(?: ?(?=[A-Z]{0,3}[0-9])[A-Z0-9]{4}){1,6}(?: ?(?=[A-Z]{0,2}[0-9])[A-Z0-9]{1,3})?\b",
    "phone": rf"(?:{PHONE10}|{PHONE_ANY}|{PHONE_PLAIN})(?![0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9]|[./-][0-9])",
    "card": r"(?<![0-9-])(?:[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7})(?![0-9]|-[0-9])",
}
ANY = "|".join(PATTERNS.values())
LETTERS, DIGITS26 = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnop"


class Cipher:
    """Column expressions of one key. ``back`` undoes what the same key has done."""

    def __init__(self, key: str, back: bool = False):
        self.key, self.back = key, back

    def _hash(self, tweak: str, i: Column, x: Column) -> Column:
        h = F.sha2(F.concat_ws("|", F.lit(self.key), F.lit(tweak), i.cast("string"), x.cast("string")), 256)
        return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")

    def pair(self, x: Column, y: Column, mx: Column, my: Column, tweak: str) -> Column:
        """A permutation of the pairs (x, y) with 0 <= x < mx and 0 <= y < my: struct(x, y)."""
        start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))

        def modulus(i: Column) -> Column:
            return F.when(i % 2 == 0, mx).otherwise(my).cast("long")

        def forth(s: Column, i: Column) -> Column:
            return F.struct(s["y"].alias("x"), F.pmod(s["x"] + F.pmod(self._hash(tweak, i, s["y"]), modulus(i)), modulus(i)).alias("y"))

        def back(s: Column, i: Column) -> Column:
            return F.struct(F.pmod(s["y"] - F.pmod(self._hash(tweak, i, s["x"]), modulus(i)), modulus(i)).alias("x"), s["x"].alias("y"))

        rounds = range(ROUNDS)
        return F.aggregate(F.array(*[F.lit(i) for i in (reversed(rounds) if self.back else rounds)]), start, back if self.back else forth)

    def string(self, s: Column, base: int, tweak: str) -> Column:
        """A permutation of the digit strings of each length, in blocks whose halves fit a long."""
        block = {10: 36, 26: 24}[base]

        def one(part: Column) -> Column:
            n = F.length(part)
            u = F.floor(n / 2).cast("int")
            v = n - u
            number = lambda t: F.coalesce(F.conv(t, base, 10).cast("long"), F.lit(0))
            power = lambda k: F.round(F.pow(F.lit(float(base)), k)).cast("long") if base != 10 else F.rpad(F.lit("1"), k + 1, "0").cast("long")
            text = lambda x, k: F.when(k == 0, F.lit("")).otherwise(F.lpad(F.lower(F.conv(x.cast("string"), 10, base)), k, "0"))
            out = self.pair(number(F.substr(part, F.lit(1), u)), number(F.substr(part, u + 1, v)), power(u), power(v), tweak)
            done = F.transform(F.array(out), lambda p: F.concat(text(p["x"], u), text(p["y"], v)))
            return F.get(done, F.lit(0))

        parts = F.sequence(F.lit(0), F.floor((F.length(s) - 1) / block).cast("int"))
        joined = F.array_join(F.transform(parts, lambda k: one(F.substr(s, k * block + 1, F.lit(block)))), "")
        return F.when(F.length(s) == 0, F.lit("")).otherwise(joined)

    def refill(self, value: Column, digits: Column, kind: str = "0-9") -> Column:
        """``value`` with its digits (or the characters of ``kind``) replaced in order by ``digits``."""
        chars = F.split(value, "")
        nth = lambda i: F.length(F.regexp_replace(F.array_join(F.slice(chars, 1, i + 1), ""), f"[^{kind}]", ""))
        return F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike(f"^[{kind}]$"), F.substr(digits, nth(i), F.lit(1))).otherwise(c)), "")

    def letters_and_digits(self, s: Column, tweak: str) -> Column:
        """Letters for letters (in the same case), digits for digits, all else in place."""
        low = F.translate(s, LETTERS.upper(), LETTERS)
        digits = self.string(F.regexp_replace(low, "[^0-9]", ""), 10, tweak)
        letters = F.regexp_replace(low, "[^a-z]", "")
        letters = F.translate(self.string(F.translate(letters, LETTERS, DIGITS26), 26, tweak), DIGITS26, LETTERS)

        def put(ds: Column, ls: Column) -> Column:
            chars = F.split(s, "")
            before = lambda i, drop: F.length(F.regexp_replace(F.array_join(F.slice(chars, 1, i + 1), ""), drop, ""))

            def char(c: Column, i: Column) -> Column:
                letter = F.substr(ls, before(i, "[^A-Za-z]"), F.lit(1))
                return (
                    F.when(c.rlike("^[0-9]$"), F.substr(ds, before(i, "[^0-9]"), F.lit(1)))
                    .when(c.rlike("^[a-z]$"), letter)
                    .when(c.rlike("^[A-Z]$"), F.upper(letter))
                    .otherwise(c)
                )

            return F.array_join(F.transform(chars, char), "")

        both = F.array(F.struct(digits.alias("d"), letters.alias("l")))  # evaluated once
        return F.get(F.transform(both, lambda p: put(p["d"], p["l"])), F.lit(0))

    # -- kinds: each gives the pseudonym, or NULL where the value is not valid -------------------------

    def secret(self, v: Column) -> Column:
        word = F.regexp_extract(v, r"^(?i:[a-z_-]+[\"']?\s{0,3}[=:]\s{0,3}[\"']?)", 0)
        rest = F.substr(v, F.length(word) + 1, F.length(v))
        blocks = F.sequence(F.lit(0), F.floor((F.length(rest) - 1) / SECRET_BLOCK).cast("int"))
        new = F.transform(blocks, lambda k: self.letters_and_digits(F.substr(rest, k * SECRET_BLOCK + 1, F.lit(SECRET_BLOCK)), "secret"))
        return F.concat(word, F.array_join(new, ""))

    def email(self, v: Column) -> Column:
        name = F.substring_index(v, "@", 1)
        return F.concat(self.letters_and_digits(name, "email"), F.lit("@"), F.substring_index(v, "@", -1))

    def card(self, v: Column) -> Column:
        d = F.regexp_replace(v, "[^0-9]", "")
        middle = self.string(F.substr(d, F.lit(2), F.length(d) - 2), 10, "card")
        new = F.concat(F.substr(d, F.lit(1), F.lit(1)), middle)
        digit = F.pmod(10 - luhn(F.concat(new, F.lit("0"))) % 10, F.lit(10))
        return F.when(F.length(d).between(13, 19) & (luhn(d) % 10 == 0), self.refill(v, F.concat(new, digit.cast("string"))))

    def iban(self, v: Column) -> Column:
        s = F.regexp_replace(v, " ", "")
        country = F.substr(s, F.lit(1), F.lit(2))
        account = F.substr(s, F.lit(5), F.length(s))
        # Letters count as two digits, 10 to 35.
        add = lambda acc, c: F.when(c.rlike("[A-Z]"), acc * 100).otherwise(acc * 10) + F.coalesce(F.conv(c, 36, 10).cast("int"), F.lit(0))
        rest = lambda a, check: F.aggregate(F.split(F.concat(a, country, check), ""), F.lit(0), lambda acc, c: add(acc, c) % 97)
        new = self.letters_and_digits(account, "iban")
        check = F.lpad((98 - rest(new, F.lit("00"))).cast("string"), 2, "0")
        valid = (F.length(account) <= 30) & (rest(account, F.substr(s, F.lit(3), F.lit(2))) == 1)
        return F.when(valid, self.refill(v, F.concat(country, check, new), "A-Z0-9"))

    def ssn(self, v: Column) -> Column:
        area, group, serial = (F.substr(v, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        x = area - F.when(area > 666, 2).otherwise(1)  # 0 .. 897
        out = self.pair(x, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), "ssn")

        def text(p: Column) -> Column:
            a = p["x"] + F.when(p["x"] >= 665, 2).otherwise(1)
            g = F.floor(p["y"] / 9999) + 1
            return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in ((a, 3), (g, 2), (p["y"] % 9999 + 1, 4))])

        return F.when(valid, F.get(F.transform(F.array(out), text), F.lit(0)))

    def phone(self, v: Column) -> Column:
        country = F.regexp_extract(v, r"^\+([0-9]{1,3}?)[ -]?\(?[0-9]{3}\)?[ -]?[0-9]{3}[ -]?[0-9]{4}$", 1)
        d = F.regexp_replace(v, "[^0-9]", "")
        d = F.substr(d, F.length(country) + 1, F.lit(10))
        area, exchange, line = (F.substr(d, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (4, 3), (7, 4)))
        out = self.pair(area - 200, (exchange - 200) * 10000 + line, F.lit(800), F.lit(8_000_000), "phone")
        text = lambda p: F.concat((p["x"] + 200).cast("string"), (p["y"] + 2_000_000).cast("string"))
        usual = F.get(F.transform(F.array(out), text), F.lit(0))
        new = F.when((area >= 200) & (exchange >= 200), usual).otherwise(self.string(d, 10, "phone-other"))
        other = F.when((area >= 200) & (exchange >= 200), F.lit(True)).otherwise(F.length(d) == 10)
        usual_form = F.when(other, self.refill(v, F.concat(country, new)))
        # Other groupings keep the country code (the first two digits where nothing sets it off) and have 8 to 15 digits.
        digits = F.regexp_replace(v, "[^0-9]", "")
        code = F.when(v.startswith("+"), F.coalesce(F.nullif(F.regexp_extract(v, r"^\+([0-9]{1,3})[ .(-]", 1), F.lit("")), F.substr(digits, F.lit(1), F.lit(2)))).otherwise("")
        own = self.string(F.substr(digits, F.length(code) + 1, F.length(digits)), 10, "phone-any")
        any_form = F.when(F.length(digits).between(8, 15), self.refill(v, F.concat(code, own)))
        return F.when(v.rlike(f"^{PHONE10}$"), usual_form).otherwise(any_form)

    def ip(self, v: Column) -> Column:
        octets = F.transform(F.split(v, r"\."), lambda o: o.cast("long"))
        at = lambda i: F.get(octets, F.lit(i))
        plain = F.concat_ws(".", *[at(i).cast("string") for i in range(4)])
        valid = F.forall(octets, lambda o: o <= 255) & (plain == v)  # no leading zeros
        out = self.pair(at(0) * 256 + at(1), at(2) * 256 + at(3), F.lit(65536), F.lit(65536), "ip")
        text = lambda p: F.concat_ws(".", *[x.cast("string") for h in "xy" for x in (F.floor(p[h] / 256), p[h] % 256)])
        return F.when(valid, F.get(F.transform(F.array(out), text), F.lit(0)))

    def date(self, v: Column) -> Column:
        """Days above 12 and up to 12 are permuted among themselves, so each reading stays and all orders stay linked."""
        dotted, slashed = v.contains("."), v.contains("/")
        p = lambda a, n: F.substr(v, F.lit(a), F.lit(n))
        ymd = lambda y, m, d: F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-MM-dd")
        day_first, month_first = ymd(p(7, 4), p(4, 2), p(1, 2)), ymd(p(7, 4), p(1, 2), p(4, 2))
        # A slashed date is read with the month first; where that is no day, the day is first and below stays so.
        given = F.when(dotted, day_first).when(slashed, F.coalesce(month_first, day_first)).otherwise(ymd(p(1, 4), p(6, 2), p(9, 2)))
        start = F.lit("1800-01-01").cast("date")
        month = (F.year(given) - 1800) * 12 + F.month(given) - 1  # 0 .. 4799
        day = F.dayofmonth(given)
        late = day > 12
        n = F.when(late, F.datediff(given, start) - 12 * (month + 1)).otherwise(month * 12 + day - 1)  # below 88,497 or 57,600
        width = F.when(late, 9833).otherwise(240)
        out = self.pair(F.floor(n / width), n % width, F.when(late, 9).otherwise(240), width, "date")

        def late_day(i: Column) -> Column:
            near = F.transform(F.array(*[F.lit(k) for k in (-1, 0, 1)]), lambda k: (F.floor(i * 4800 / 88_497) + k).cast("int"))
            days = F.transform(near, lambda m: F.date_add(start, (i + 12 * (m + 1)).cast("int")))
            return F.get(F.filter(days, lambda d, k: F.trunc(d, "month") == F.add_months(start, F.get(near, k))), F.lit(0))

        def text(q: Column) -> Column:
            i = q["x"] * width + q["y"]
            early_day = F.date_add(F.add_months(start, F.floor(i / 12).cast("int")), (i % 12).cast("int"))
            new = F.array(F.when(late, late_day(i)).otherwise(early_day))
            slashes = lambda d: F.when(month_first.isNull(), F.date_format(d, "dd/MM/yyyy")).otherwise(F.date_format(d, "MM/dd/yyyy"))
            form = lambda d: F.when(dotted, F.date_format(d, "dd.MM.yyyy")).when(slashed, slashes(d)).otherwise(F.date_format(d, "yyyy-MM-dd"))
            return F.get(F.transform(new, form), F.lit(0))

        return F.when(month.between(0, 4799), F.get(F.transform(F.array(out), text), F.lit(0)))

    def value(self, v: Column) -> Column:
        """struct(kind, new): the first kind whose whole form the value has; kind is NULL where it is not valid."""
        found = [(k, getattr(self, k)(v)) for k in PATTERNS]
        new = reduce(lambda rest, k: F.when(v.rlike(f"^(?:{PATTERNS[k[0]]})$"), k[1]).otherwise(rest), reversed(found), F.lit(None).cast("string"))
        kind = reduce(lambda rest, k: F.when(v.rlike(f"^(?:{PATTERNS[k]})$"), F.lit(k)).otherwise(rest), reversed(PATTERNS), F.lit(None).cast("string"))
        return F.struct(kind.alias("kind"), new.alias("new"), v.alias("old"))


def luhn(d: Column) -> Column:
    """The Luhn sum of a digit string that ends with its check digit."""

    def one(c: Column, i: Column) -> Column:
        x = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.transform(F.split(F.reverse(d), ""), one), F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0)))


def _replaced(text: Column, cipher: Cipher) -> Column:
    """struct(text, kinds) of one text."""
    found = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), cipher.value)

    def join(values: Column) -> Column:
        gaps = F.split(text, ANY, -1)
        put = F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(values, i)["new"], F.get(values, i)["old"], F.lit(""))))
        kinds = F.transform(F.filter(values, lambda x: x["new"].isNotNull()), lambda x: x["kind"])
        return F.struct(F.array_join(put, "").alias("text"), kinds.alias("kinds"))

    return F.get(F.transform(F.array(found), join), F.lit(0))


def pseudonymise(docs: DataFrame, key: str = KEY, back: bool = False) -> DataFrame:
    """(row, text, kinds): the columns of ``docs`` in the struct ``row``, the new text, the kind of each replaced value.

    Only texts with a digit or an at sign are searched.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row.text")
    # A secret may have letters only, but comes after an equals sign or a colon.
    out = rows.withColumn("_new", F.when(text.rlike("[0-9@=:]"), _replaced(text, Cipher(key, back))))
    return out.select("row", F.coalesce("_new.text", text).alias("text"), F.coalesce("_new.kinds", F.array().cast("array<string>")).alias("kinds"))


def reveal(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The inverse of ``pseudonymise`` with the same key."""
    return pseudonymise(docs, key, back=True)
