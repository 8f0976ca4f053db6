"""Column expressions shared by the operators. All are built-in Spark
functions, so they stay JVM-side and inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed report markers.
EMPTY = "(empty)"   # min/max of an empty table
ABSENT = "-"        # a metric one side does not have

#: Values of so many digits can be summed 10**18 times within 38 digits.
WIDE_FROM = 20


def named(name: str) -> Column:
    """The column with exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def _col(c) -> Column:
    return named(c) if isinstance(c, str) else c


def decimal_type(scale: int) -> str:
    return f"decimal(38,{scale})"


def rowcount_text() -> Column:
    return F.count(F.lit(1)).cast("string")


def loses_nothing(c: Column, out: Column, source, target) -> Column | None:
    """Whether a cast to ``target`` kept the whole value, where a cast may drop a part
    of it without an error (a fraction, a time of day); None where it cannot."""
    from pyspark.sql import types as T
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(target, whole) and isinstance(source, (T.FloatType, T.DoubleType)):
        return out.cast("double") == c.cast("double")
    if isinstance(target, whole) and isinstance(source, T.DecimalType):
        return c == out.cast(source)
    if isinstance(target, whole) and isinstance(source, T.StringType):
        return F.trim(c).rlike(r"^[+-]?[0-9]+$")
    if isinstance(target, T.DateType) and isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return out.cast(source) == c
    return None


def exact_cast(c: Column, source, target, ansi: bool) -> Column:
    """Cast that raises where the value does not fit or would lose a part; rounding to
    fewer decimals is the target's own rule and allowed."""
    out = c.cast(target) if ansi else strict_cast(c, target)
    kept = loses_nothing(c, out, source, target)
    if kept is None:
        return out
    bad = F.raise_error(F.concat(F.lit(f"value is not a whole {target.simpleString()}: "), c.cast("string")))
    return F.when(c.isNull() | kept, out).otherwise(bad.cast(target))


def strict_cast(c, data_type) -> Column:
    """Cast that fails instead of turning a value that does not fit into
    null, whatever the session's ANSI setting."""
    c = _col(c)
    out = c.cast(data_type)
    return F.when(c.isNotNull() & out.isNull(),
                  F.raise_error(F.concat(F.lit("value does not fit "),
                                         F.lit(data_type if isinstance(data_type, str)
                                               else data_type.simpleString()))).cast(data_type)
                  ).otherwise(out)


def fits_decimal38(data_type, scale: int) -> bool:
    """True when every value of ``data_type`` fits decimal(38, scale), so the
    cast cannot fail: integers (at most 19 digits) and decimals whose
    integer digits, a rounding carry and ``scale`` stay within 38."""
    from pyspark.sql import types as T
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return 19 + scale <= 38
    if isinstance(data_type, T.DecimalType):
        return data_type.precision - data_type.scale + 1 + scale <= 38
    return False


def exact_sum_text(c, scale: int, data_type=None, ansi: bool = False) -> Column:
    """Exact sum at ``scale``: every value is cast to decimal(38, scale) before
    summing (rounding half up), the sum of no values is 0, and the value is
    rendered as plain text so that text equality is value equality. Decimals of more
    than ``WIDE_FROM`` digits, whose sum may pass 38, are summed in two limbs
    (``wide_sum_text``). Any other value that does not fit, or sum past 38 digits, raises
    (the table becomes an ERROR row) in ANSI and non-ANSI sessions alike, never a silent
    loss.

    With ``ansi`` (the session's mode) Spark itself raises on both, so the
    plain expression is used; otherwise explicit checks are added. A cast
    that cannot fail (``data_type`` fits) is never checked per value."""
    t = decimal_type(scale)
    x = _col(c)
    if data_type is not None and data_type.typeName() == "decimal" and data_type.precision > WIDE_FROM:
        return wide_sum_text(x.cast(t) if ansi or fits_decimal38(data_type, scale) else strict_cast(x, t), scale)
    if ansi:
        return F.coalesce(F.sum(x.cast(t)), F.lit(0).cast(t)).cast("string")
    value = x.cast(t) if data_type is not None and fits_decimal38(data_type, scale) \
        else strict_cast(x, t)
    total = F.sum(value)
    return (F.when(F.count(x) == 0, F.lit(0).cast(t).cast("string"))
            .when(total.isNull(), F.raise_error(F.lit("sum overflows " + t)).cast("string"))
            .otherwise(total.cast("string")))


def ansi_enabled(df) -> bool:
    return df.sparkSession.conf.get("spark.sql.ansi.enabled", "false").lower() == "true"


def key_bound_text(fn, c, data_type=None, ansi: bool = False) -> Column:
    """min/max of a key as text, ``(empty)`` for an empty table. An integer is shown as it
    is, and so is one that a side holds as text, which is read as an integer first; any
    other number with the decimals it has (18 at most) and no trailing zeros, so that 1.00
    and 1 are the same bound and 1.4 and 1 are not."""
    value = _col(c)
    if data_type is not None and data_type.typeName() in ("string", "char", "varchar"):
        from pyspark.sql import types as T
        value, data_type = exact_cast(value, T.StringType(), T.LongType(), ansi), None
    bound = fn(value)
    if data_type is None or data_type.typeName() in ("byte", "short", "integer", "long"):
        text = bound.cast(decimal_type(0)).cast("string")
    else:
        scale = data_type.scale if data_type.typeName() == "decimal" else 18
        text = bound.cast(decimal_type(scale)).cast("string")
        text = F.when(F.instr(text, ".") > 0, F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)
    return F.coalesce(text, F.lit(EMPTY))


#: Digits of the low limb of a number wider than 38 digits.
LOW_DIGITS = 18


def _let(body, **values: Column) -> Column:
    """``body`` of the named values, each evaluated once instead of copied into every place
    that uses it."""
    one = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return F.get(F.transform(one, lambda x: body(*[x[k] for k in values])), 0)


def _whole(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def _limbs(digits: Column) -> Column:
    """(high, low) of a whole number in text, each with its sign; null past 56 digits."""
    def split(sign, bare):
        cut = F.greatest(F.length(bare) - LOW_DIGITS, F.lit(0))
        return F.struct(F.concat(sign, F.lit("0"), F.substr(bare, F.lit(1), cut)).try_cast("decimal(38,0)").alias("high"),
                        F.concat(sign, F.lit("0"), F.substr(bare, cut + 1)).try_cast("decimal(38,0)").alias("low"))

    return _let(split, sign=F.when(F.startswith(digits, F.lit("-")), "-").otherwise(""),
                bare=F.ltrim(F.regexp_replace(digits, "^[+-]", ""), F.lit("0")))


def _limb_text(high: Column, low: Column, scale: Column) -> Column:
    """high * 10 ** LOW_DIGITS + low as plain text with ``scale`` decimals. The low limb
    may hold any number of carries and another sign than the high one."""
    unit = _whole(F.lit(10**LOW_DIGITS))

    def carried(high, low, rest):
        return _let(signed, top=_whole(F.try_add(high, _whole((low - rest) / unit))), rest=rest)

    def signed(top, rest):  # both limbs with one sign
        borrow = _whole(F.when((top > 0) & (rest < 0), 1).when((top < 0) & (rest > 0), -1).otherwise(0))
        return _let(joined, top=_whole(top - borrow), rest=_whole(rest + _whole(borrow * unit)))

    def joined(top, rest):
        digits = F.concat(F.abs(top).cast("string"), F.lpad(F.abs(rest).cast("string"), LOW_DIGITS, "0"))
        return _let(lambda sign, bare: _let(shown, sign=sign, digits=F.lpad(bare, F.greatest(F.length(bare), scale + 1), F.lit("0"))),
                    sign=F.when((top < 0) | (rest < 0), "-").otherwise(""), bare=F.ltrim(digits, F.lit("0")))

    def shown(sign, digits):
        cut = F.length(digits) - scale
        return F.concat(sign, F.when(scale == 0, digits).otherwise(F.concat(F.substr(digits, F.lit(1), cut), F.lit("."), F.substr(digits, cut + 1))))

    return _let(carried, high=high, low=low, rest=_whole(low % unit))


def wide_sum_text(value: Column, scale: int) -> Column:
    """Exact sum of decimal(38, scale) values as text, whatever its number of digits: the
    high digits and the last 18 of each value are summed apart and put together at the
    end, with the carries. The coefficient that the value's text shows, plain or with an
    exponent, is its unscaled whole number."""
    parts = _limbs(F.replace(F.substring_index(value.cast("string"), "E", 1), F.lit("."), F.lit("")))
    sums = [F.coalesce(F.sum(parts[x]), _whole(F.lit(0))) for x in ("high", "low")]
    return _limb_text(*sums, F.lit(scale))


def abs_difference_text(a: Column, b: Column) -> Column:
    """abs(a - b) of two decimals given as plain text, exact to the last digit.

    Both are brought to the longer fraction and subtracted as whole numbers of two limbs,
    because a decimal subtraction at full precision drops a digit of the scale. Null if a
    number has more than 56 digits."""
    def fraction(x):
        return F.when(F.instr(x, ".") > 0, F.substring_index(x, ".", -1)).otherwise("")

    def scaled(a, b, scale):
        whole = [_limbs(F.concat(F.substring_index(x, ".", 1), F.rpad(fraction(x), scale, F.lit("0")))) for x in (a, b)]
        return _let(apart, a=whole[0], b=whole[1], scale=scale)

    def apart(a, b, scale):
        return F.ltrim(_limb_text(_whole(F.try_subtract(a["high"], b["high"])), _whole(a["low"] - b["low"]), scale), F.lit("-"))

    return _let(scaled, a=a, b=b, scale=F.greatest(F.length(fraction(a)), F.length(fraction(b))))


def text_digest(c) -> Column:
    """Binary stand-in for a text value, compared instead of the text: its SHA-256, 32
    bytes whatever the text's length. Null stays null. Parity with ``digest=False``
    compares the raw bytes instead, which rules out even a hash collision.
    """
    return F.unhex(F.sha2(_col(c).cast("binary"), 256))


def guid_from_le_bytes(c) -> Column:
    """16 bytes with the first three groups little-endian -> canonical uuid.

    Null stays null; any other length raises, as a bad GUID must not pass.
    """
    c = _col(c)
    text = F.regexp_replace(F.lower(F.hex(c)), "^" + "(..)" * 8 + "(.{4})(.{12})$", "$4$3$2$1-$6$5-$8$7-$9-$10")
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(F.octet_length(c) == 16, text)
            .otherwise(F.raise_error(F.lit("GUID must have 16 bytes")).cast("string")))


_GROUPS = ("([0-9a-f]{8})", "([0-9a-f]{4})", "([0-9a-f]{4})", "([0-9a-f]{4})", "([0-9a-f]{12})")
#: A uuid with or without hyphens and braces; 32 digits, and the line end that ``$`` takes too.
_PLAIN_UUID = r"^\{*" + "-?".join(_GROUPS) + r"\}*\z"
_BARE_UUID = "^" + "".join(_GROUPS) + r"(?:\r\n|[\n\r\u0085\u2028\u2029])?\z"


def guid_from_text(c) -> Column:
    """Text uuid in any accepted spelling (braces, urn:uuid: prefix, no
    hyphens, upper case) -> canonical lower-case 8-4-4-4-12 text."""
    c, spaced = _col(c), "$1-$2-$3-$4-$5"
    bare = F.regexp_replace(F.regexp_replace(c, r"urn:|uuid:", ""), r"^\{+|\}+$|-", "")
    failed = F.raise_error(F.concat(F.lit("badly formed uuid: "), c)).cast("string")
    # computed once, in a lambda's argument; hyphens are back only where the whole text is a uuid
    other = F.transform(F.array(F.regexp_replace(F.lower(bare), _BARE_UUID, spaced)),
                        lambda text: F.when(F.contains(text, F.lit("-")), text).otherwise(failed))[0]
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(F.lower(c).rlike(_PLAIN_UUID), F.regexp_replace(F.lower(c), _PLAIN_UUID, spaced))
            .otherwise(other))


def canonical_uuid(c, data_type) -> Column:
    """GUID column of either physical form -> canonical uuid text."""
    from pyspark.sql import types as T
    if isinstance(data_type, T.BinaryType):
        return guid_from_le_bytes(c)
    return guid_from_text(c)


def target_value(name: str, own, target, logical: str | None, ansi: bool) -> Column:
    """Column ``name`` (of type ``own``) as the target's column holds it: a uuid of either
    physical form in its canonical text, other values by ``exact_cast``. Bytes that are no
    uuid are never turned into text."""
    from pyspark.sql import types as T
    if logical == "uuid" and isinstance(target, T.StringType):
        return canonical_uuid(named(name), own)
    if own == target:
        return named(name)
    if isinstance(own, T.BinaryType) and isinstance(target, T.StringType):
        raise ValueError(f"column {name} holds bytes, not text")
    return exact_cast(named(name), own, target, ansi)


def canonical_json(c) -> Column:
    """A JSON text without what its meaning leaves open: key order, white space, escapes and
    trailing zeros of a fraction. Numbers that a parser would round (an exponent, 39 digits
    and more) count as spelled. A text that is no JSON, or repeats a key, counts as it is."""
    c = _col(c)
    spelled = F.array_sort(F.regexp_extract_all(c, F.lit("(?<![0-9A-Za-z.+-])-?(?:[0-9][0-9.]*[eE][+-]?[0-9]+|[0-9.]{39,})"), F.lit(0)))
    parsed = F.to_json(F.try_parse_json(c))
    return F.when(parsed.isNotNull(), F.concat(parsed, F.array_join(spelled, " "))).otherwise(F.concat(F.lit("as is: "), c))
