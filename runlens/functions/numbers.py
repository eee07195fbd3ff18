"""Numbers as the text that a launcher written in Python prints."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value made once and, however often it is used, stated once in the plan."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _shortest(x: Column) -> Column:
    """Text of a DOUBLE as the JVM prints it, but without digits beyond those that tell it from its neighbours."""

    def cut(plain: Column) -> Column:
        long = F.length(F.regexp_replace(plain, "[-.]|E.*", "")) > 16
        # some JVMs print more digits than it takes to tell a number from its neighbours
        shorter = [
            _let(F.format_string(f"%.{k}e", x), lambda c: F.when(c.cast("double") == x, F.regexp_replace(F.regexp_replace(c, "0+e", "e"), "e[+]?", "E")))
            for k in (15, 16)
        ]
        return F.when(long, F.coalesce(*shorter, plain)).otherwise(plain)

    return _let(x.cast("string"), cut)


def _moved(sign: Column, mantissa: Column, power: Column) -> Column:
    """Text of a number with an exponent, its point moved as Python does."""
    digits = F.replace(mantissa, F.lit("."), F.lit(""))
    after = F.substr(digits, power + 2)
    large = F.concat(F.rpad(F.substr(digits, F.lit(1), power + 1), power + 1, F.lit("0")), F.lit("."), F.when(F.length(digits) > power + 1, after).otherwise("0"))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    two = F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), F.lit("0"))
    other = F.concat(mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"), two)
    return F.concat(sign, F.when((power >= 0) & (power < 16), large).when((power < 0) & (power >= -4), small).otherwise(other))


def float_text(x: Column) -> Column:
    """Text of a DOUBLE: always with a point or an exponent, positional from 0.0001 to below 10^16."""

    def of_parts(p: Column) -> Column:
        special = F.when(F.isnan(p["x"]), "nan").when(F.abs(p["x"]) == float("inf"), F.concat(p["sign"], F.lit("inf")))
        return F.coalesce(special, F.when(p["power"].isNull(), p["text"]).otherwise(_moved(p["sign"], p["mantissa"], p["power"])))

    def of_text(x: Column, text: Column) -> Column:
        parts = F.split(F.regexp_replace(text, "^-", ""), "E")
        told = F.struct(
            x.alias("x"),
            text.alias("text"),
            F.when(text.startswith("-"), "-").otherwise("").alias("sign"),
            F.regexp_replace(F.get(parts, F.lit(0)), r"\.0?$", "").alias("mantissa"),
            F.get(parts, F.lit(1)).try_cast("int").alias("power"),
        )
        return _let(told, of_parts)

    whole = lambda x: F.when(x.isNotNull(), _let(_shortest(x), lambda text: of_text(x, text)))
    return _let(x.cast("double"), whole)


def number_text(x: Column, whole: Column) -> Column:
    """Text of a DOUBLE that stands for an integer where ``whole`` says so."""
    as_integer = F.when(whole & ~F.isnan(x), x.cast("decimal(38,0)").cast("string"))
    return F.coalesce(as_integer, float_text(x))
