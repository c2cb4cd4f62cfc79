"""Column expressions. All are Spark built-ins, so plans stay in generated code."""

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession, functions as F

from tillmart.functions.vocabulary import CLASS_KEYWORDS
from tillmart.schemas import FLAGS, MONEY, PRICE

INVOICE_TIME_PATTERN = "M/d/yy H:mm"
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def lenient_int(text: Column) -> Column:
    """Whole number in a text such as ``17850`` or ``17850.0``, a fraction cut off; NULL if it is no plain number."""
    whole = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)(\.[0-9]*)?\s*$", 1)
    return F.nullif(whole, F.lit("")).try_cast("int")


def lenient_price(text: Column) -> Column:
    return text.try_cast(PRICE)


def wall_clock(text: Column, patterns: Iterable[str] = (INVOICE_TIME_PATTERN,)) -> Column:
    """Timestamp without zone from the first pattern that fits; NULL if none does.

    Outside UTC the text is read as UTC and counted from the epoch, so that a
    clock change in the session's own zone moves no value.
    """
    if SparkSession.active().conf.get("spark.sql.session.timeZone") in UTC_NAMES:
        parsed = [F.try_to_timestamp(text, F.lit(pattern)) for pattern in patterns]
        return F.coalesce(*parsed).cast("timestamp_ntz")
    parsed = [F.try_to_timestamp(F.concat(text, F.lit(" Z")), F.lit(f"{pattern} X")) for pattern in patterns]
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(F.coalesce(*parsed)), epoch)


def joined_hash(*columns: Column, algorithm: str = "sha256") -> Column:
    """Hash of the non-NULL values joined by ``_``.

    It is never NULL, and ``coalesce`` tells the planner so: a join on the key
    then needs no NULL check, for which the hash would be worked out twice.
    """
    joined = F.concat_ws("_", *columns)
    if algorithm == "md5":
        hashed = F.md5(joined)
    elif algorithm == "sha256":
        hashed = F.sha2(joined, 256)
    else:
        raise ValueError(f"no such hash: {algorithm}")
    return F.coalesce(hashed, F.lit(""))


def packed(text: Column) -> Column:
    """A text as bytes, one to one, so that keys are shuffled in half the bytes: those that a lower-case hex text stands for, else its own."""
    of_hex = F.unhex(text)
    return F.when(F.lower(F.hex(of_hex)) == text, F.concat(F.expr("X'01'"), of_hex)).otherwise(F.concat(F.expr("X'00'"), text.cast("binary")))


def unpacked(key: Column) -> Column:
    """The text that ``packed`` has made ``key`` of."""
    rest = F.substring(key, 2, 2**31 - 1)
    return F.when(F.substring(key, 1, 1) == F.expr("X'01'"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def short(text: Column) -> Column:
    """A 64-bit hash of ``packed``, for distinct counts where no two texts are known to share one."""
    return F.when(text.isNotNull(), F.xxhash64(packed(text)))


def flag_bits(flags: Iterable[str]) -> Column:
    """Flags as one number, two bits each, so that ``bit_or`` of it is ``bool_or`` of each of them: whether it is known, and whether it is true."""
    bits = F.lit(0)
    for place, flag in enumerate(flags):
        bits = bits + F.when(F.col(flag), F.lit(3 << 2 * place)).when(F.col(flag).isNotNull(), F.lit(1 << 2 * place)).otherwise(0)
    return bits


def flag_of(bits: Column, place: int) -> Column:
    """The flag at ``place`` of ``flag_bits``."""
    return F.when(bits.bitwiseAND(F.lit(1 << 2 * place)) != 0, bits.bitwiseAND(F.lit(2 << 2 * place)) != 0)


def is_operational(item_id: Column) -> Column:
    """Codes for postage, fees and vouchers: short ones and those with 'gift'."""
    return F.coalesce((F.length(item_id) < 5) | item_id.rlike("(?i)gift"), F.lit(False))


def leading_digits(item_id: Column) -> Column:
    return F.nullif(F.regexp_extract(item_id, "^([0-9]+)", 1), F.lit(""))


def family_id(item_id: Column) -> Column:
    return leading_digits(item_id).try_cast("int")


def variant(item_id: Column) -> Column:
    """Trailing letters; NULL for an all-digit code, empty if there are none."""
    letters = F.regexp_extract(item_id, "([A-Za-z]+)$", 1)
    return F.when(item_id == leading_digits(item_id), F.lit(None)).otherwise(F.coalesce(letters, F.lit("")))


def in_texts(description: Column, texts: list[str]) -> Column:
    """Membership in a list; a NULL description is in none."""
    return F.coalesce(description.isin(texts), F.lit(False))


def is_all_uppercase(text: Column) -> Column:
    """At least one letter with case, and none in lower case."""
    return (F.upper(text) == text) & (F.lower(text) != text)


def keyword_class(text: Column, keywords: dict[str, list[str]] = CLASS_KEYWORDS) -> Column:
    """First class with a keyword in the lower-cased text; NULL if none has."""
    lowered = F.lower(text)
    chosen = F.lit(None).cast("string")
    for name in reversed(list(keywords)):
        hit = F.lit(False)
        for keyword in keywords[name]:
            hit = hit | lowered.contains(keyword)
        chosen = F.when(hit, F.lit(name)).otherwise(chosen)
    return chosen


def words(text: Column) -> Column:
    """Array of the words between white space."""
    return F.filter(F.split(text, r"\s+"), lambda word: word != "")


def line_total(quantity: Column, price: Column) -> Column:
    return F.round(quantity * price, 2).try_cast(MONEY)


def is_return(quantity: Column, total: Column) -> Column:
    """A normal item with a negative quantity or amount; never NULL."""
    normal = F.lit(True)
    for flag in FLAGS:
        normal = normal & ~F.col(flag)
    return F.coalesce(normal & ((quantity < 0) | (total < 0)), F.lit(False))


def ratio(total: Column, count: Column) -> Column:
    return F.round(total / F.nullif(count, F.lit(0)), 2)


def lookup(key: Column, mapping: dict[str, str], default: str) -> Column:
    """Value of a constant map, or ``default``."""
    entries = F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])
    return F.coalesce(F.try_element_at(entries, key), F.lit(default))
