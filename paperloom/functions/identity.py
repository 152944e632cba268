"""Deterministic identities: canonical JSON, content hashes and stable ids, as column expressions.

A content hash is the SHA-256 of canonical JSON: keys sorted, no spaces, UTF-8, non-ASCII kept. A stable id is a
prefix and the first characters of the lower-case base32 form of that hash.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import let

#: Fixed value: the base32 alphabet of RFC 4648 in lower case.
BASE32 = "abcdefghijklmnopqrstuvwxyz234567"
ID_LENGTH = 26
#: Control characters whose escapes the JSON writer spells with upper-case digits.
_UPPER_ESCAPES = ["000B", "000E", "000F", "001A", "001B", "001C", "001D", "001E", "001F"]


def canonical_json(**fields: Column) -> Column:
    """Canonical JSON of an object with these fields (strings, integers, booleans, nulls)."""
    text = F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})
    return _lower_escapes(text)


def _lower_escapes(text: Column) -> Column:
    fixed = text
    for code in _UPPER_ESCAPES:
        fixed = F.regexp_replace(fixed, rf"(?<!\\)((?:\\\\)*)\\u{code}", rf"$1\\u{code.lower()}")
    return F.when(F.contains(text, F.lit("\\u00")), fixed).otherwise(text)


def _quoted(text: Column) -> Column:
    """A text as a JSON string."""
    listed = F.to_json(F.array(text))
    return _lower_escapes(F.substring(listed, 2, F.length(listed) - 2))


def number_text(value: Column) -> Column:
    """A double's shortest text: plain from 0.0001 up to below 1e16, else with an exponent of two digits at least.

    Spark may give more digits than are needed; the fewest that are the same double are taken (where two texts of that
    length are, and Spark's digits lie in their middle, the larger).
    """

    def spelled(d: Column) -> Column:
        text = F.abs(d).cast("string")
        whole, fraction = F.regexp_extract(text, r"^(\d+)", 1), F.regexp_extract(text, r"\.(\d+)", 1)
        power = F.coalesce(F.try_to_number(F.regexp_extract(text, r"E(-?\d+)$", 1), F.lit("S999")), F.lit(0)).cast("int")
        return let(F.struct(F.concat(whole, fraction).alias("digits"), (F.length(whole) + power).alias("point")), lambda x: placed(d, x["digits"], x["point"]))

    def placed(d: Column, digits: Column, point: Column) -> Column:
        zeros = F.length(digits) - F.length(F.ltrim(digits, F.lit("0")))
        return let(F.struct(F.rtrim(F.ltrim(digits, F.lit("0")), F.lit("0")).alias("digits"), (point - zeros).alias("point")), lambda x: shortened(d, x["digits"], x["point"]))

    def shortened(d: Column, digits: Column, point: Column) -> Column:
        n, size = F.length(digits), F.abs(d)
        fewer = F.when(n > 15, F.filter(F.array(F.lit(15), F.lit(16), F.lit(17)), lambda k: k < n)).when((size < 2.3e-308) & (n > 1), F.array(n - 1)).otherwise(F.array().cast("array<int>"))

        def rounded(k: Column) -> Column:
            head = F.substr(digits, F.lit(1), k).cast("decimal(20,0)") + F.when(F.substr(digits, k + 1, F.lit(1)) >= "5", 1).otherwise(0)
            return let(head.cast("string"), lambda t: F.struct(t.alias("digits"), (point + F.length(t) - k).alias("point")))

        same = F.filter(F.transform(fewer, rounded), lambda x: F.concat(F.lit("0."), x["digits"], F.lit("E"), x["point"].cast("string")).cast("double") == size)
        best = F.coalesce(F.get(same, F.lit(0)), F.struct(digits.alias("digits"), point.alias("point")))
        return let(best, lambda x: written(d, F.rtrim(x["digits"], F.lit("0")), x["point"]))

    def written(d: Column, digits: Column, point: Column) -> Column:
        n = F.length(digits)
        plain = F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)).when(point >= n, F.concat(F.rpad(digits, point, F.lit("0")), F.lit(".0"))).otherwise(F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1, n)))
        e = point - 1
        head = F.concat(F.substr(digits, F.lit(1), F.lit(1)), F.when(n > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2), n))).otherwise(F.lit("")))
        exponent = F.concat(head, F.lit("e"), F.when(e < 0, "-").otherwise("+"), F.when(F.abs(e) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(e).cast("string"))
        sign = F.when(d < 0, "-").otherwise("")
        return F.concat(sign, F.when((point >= -3) & (point <= 16), plain).otherwise(exponent))

    zero = F.when(value.cast("string").startswith("-"), "-0.0").otherwise("0.0")
    return F.when(value.isNull(), None).when(value == 0, zero).otherwise(let(value, spelled))


#: What of a contract's header is no part of its identity.
EPHEMERAL = ("content_hash", "created_at")


def canonical_value(value: Column, kind: T.DataType) -> Column:
    """Canonical JSON of a value of any nesting: structs, arrays, maps of texts, and what JSON has at the leaves.

    Keys are sorted at every level; of a struct or map named ``header`` the fields EPHEMERAL are left out. A number that
    is no finite one raises an error; types without a JSON form (dates, decimals, binaries) aren't taken.
    """

    def members(name: str, inner: T.DataType) -> list[T.StructField]:
        return sorted((f for f in inner.fields if not (name == "header" and f.name in EPHEMERAL)), key=lambda f: f.name)

    def walked(x: Column, inner: T.DataType, name: str = "") -> Column:
        if isinstance(inner, T.StructType):
            parts = [F.concat(_quoted(F.lit(f.name)), F.lit(":"), walked(x.getField(f.name), f.dataType, f.name)) for f in members(name, inner)]
            made = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
        elif isinstance(inner, T.ArrayType):
            made = F.concat(F.lit("["), F.array_join(F.transform(x, lambda y: walked(y, inner.elementType)), ","), F.lit("]"))
        elif isinstance(inner, T.MapType) and isinstance(inner.keyType, T.StringType):
            keys = F.array_sort(F.map_keys(x))
            keys = F.array_except(keys, F.lit(list(EPHEMERAL))) if name == "header" else keys
            of = lambda k: F.when(k == "header", walked(F.element_at(x, k), inner.valueType, "header")).otherwise(walked(F.element_at(x, k), inner.valueType)) if isinstance(inner.valueType, (T.StructType, T.MapType)) else walked(F.element_at(x, k), inner.valueType)
            made = F.concat(F.lit("{"), F.array_join(F.transform(keys, lambda k: F.concat(_quoted(k), F.lit(":"), of(k))), ","), F.lit("}"))
        elif isinstance(inner, T.StringType):
            made = _quoted(x)
        elif isinstance(inner, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            made = x.cast("string")
        elif isinstance(inner, (T.DoubleType, T.FloatType)):
            d = x.cast("double")
            made = F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.raise_error(F.lit("numbers must be finite")).cast("string")).otherwise(number_text(d))
        else:
            raise TypeError(f"{inner.simpleString()} has no JSON form")
        return F.coalesce(F.when(x.isNotNull(), made), F.lit("null"))

    return walked(value, kind)


def content_hash(json: Column) -> Column:
    return F.sha2(F.encode(json, "UTF-8"), 256)


#: Digits of base 32 as Spark writes numbers.
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_token(digest: Column, length: int = ID_LENGTH, bound: bool = True) -> Column:
    """First characters of the base32 form of a hex digest: eight of them out of every ten hex digits, as one number.

    The digest is bound to a lambda's variable, so that it is computed once and not for every number. What a lambda holds
    is interpreted: where the token is always needed (not within a branch), Spark finds the shared digest itself, and
    compiles it if it isn't ``bound``.
    """

    def spelled(hexes: Column) -> Column:
        blocks = [F.lpad(F.conv(F.substring(hexes, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(-(-length // 8))]
        return F.substring(F.translate(F.concat(*blocks), _DIGITS, BASE32), 1, length)

    return let(digest, spelled) if bound else spelled(digest)


def stable_id(prefix: str, json: Column, length: int = ID_LENGTH, bound: bool = True) -> Column:
    if not prefix or not prefix[0].isalpha():
        raise ValueError("a prefix starts with a letter")
    return F.concat(F.lit(prefix + "_"), base32_token(content_hash(json), length, bound))


def sql_stable_id(prefix: str, json: str, length: int = ID_LENGTH) -> str:
    """The same as SQL over an expression that gives the canonical JSON."""
    hexes = "'0123456789abcdef'"
    digit = lambda at: f"(strpos({hexes}, substr(sha256({json}), {at}, 1)) - 1)"
    value = f"(({digit('CAST(5 * i // 4 AS BIGINT) + 1')} * 16 + {digit('CAST(5 * i // 4 AS BIGINT) + 2')}) >> CAST(3 - 5 * i % 4 AS INTEGER)) & 31"
    return f"('{prefix}_' || array_to_string(list_transform(range({length}), lambda i: substr('{BASE32}', CAST({value} AS BIGINT) + 1, 1)), ''))"


def bundle_hash(rows: Column) -> Column:
    """Hash of a set of rows given as an array of (ordinal, role, sha256) structs, whatever their order."""
    each = F.transform(F.array_sort(rows), lambda r: F.to_json(F.struct(r["ordinal"].alias("ordinal"), r["role"].alias("role"), r["sha256"].alias("sha256"))))
    return content_hash(F.concat(F.lit("["), F.array_join(each, ","), F.lit("]")))


#: Fixed value: what no renderer may do.
RESTRAINTS = {"field_update": "disabled", "formula_recalculation": "disabled", "macros": "disabled", "network": "denied"}


def environment_hash(profile: Column, renderer: Column, runtime: dict[str, str]) -> Column:
    """Hash of what a rendering depends on: profile, renderer, the runtime's versions and settings, and its restraints."""
    fixed = {k: F.lit(v) for k, v in {**RESTRAINTS, **runtime}.items()}
    return content_hash(canonical_json(profile=profile, renderer_family=renderer, **fixed))
