"""Formatting expressions for text sinks and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Characters that would break a line, and how they are written. The backslash comes first.
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\0", "\\0"))


def escape(value: Column) -> Column:
    """A text field without tabs and line breaks; ``unescape`` undoes it."""
    for char, written in ESCAPES:
        value = F.replace(value, F.lit(char), F.lit(written))
    return value


def unescape(value: Column) -> Column:
    """The text that ``escape`` was given: pairs of backslashes first divide the text, so that none is read twice."""
    def part(x: Column) -> Column:
        for char, written in ESCAPES[1:]:
            x = F.replace(x, F.lit(written), F.lit(char))
        return x

    return F.array_join(F.transform(F.split(value, r"\\\\", -1), part), "\\")


def fixed(value: str | Column, decimals: int) -> Column:
    """``value`` with exactly ``decimals`` digits after the point, no grouping.

    ``format_number`` rounds the binary value half-even, like Python's ``f'{x:.3f}'`` (2.675 -> 2.67,
    0.125 -> 0.12); ``format_string('%.2f')`` would round the shortest decimal form half-up instead.
    """
    return F.regexp_replace(F.format_number(_col(value), decimals), ",", "")


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element ``transform``), so that a sub-result used
    many times is not copied into the expression tree at every use."""
    return F.transform(F.array(value), body).getItem(0)


def py_float(value: str | Column) -> Column:
    """A double rendered as Python's ``str(float)``: shortest round-trip digits, fixed notation for decimal
    exponents -4..15 (``0.0001``, ``10000000.0``), otherwise ``1e-05`` / ``1.5e+16``; ``nan``, ``inf``.

    Built from the JVM's shortest-digit rendering (``cast(double as string)``) by moving the decimal point, so
    the digits are the same and only the notation changes. Meant for sinks (it runs per output row).
    """
    x = _col(value).cast("double")

    def jvm_parts(v: Column) -> Column:
        s = v.cast("string")
        body = F.regexp_replace(s, "^-", "")
        mant = F.regexp_extract(body, r"^([0-9.]+)", 1)
        return F.struct(v.alias("x"), F.startswith(s, F.lit("-")).alias("neg"),
                        F.split(mant, r"\.").getItem(0).alias("ip"),
                        F.coalesce(F.split(mant, r"\.").getItem(1), F.lit("")).alias("fp"),
                        F.regexp_extract(body, r"E(-?[0-9]+)$", 1).alias("exp"))

    def digits_and_exponent(p: Column) -> Column:
        ip, fp, exp_txt = p["ip"], p["fp"], p["exp"]
        jvm_digits = F.regexp_replace(F.regexp_replace(F.concat(ip, fp), "^0+", ""), "0+$", "")
        lead_zeros = F.length(fp) - F.length(F.regexp_replace(fp, "^0+", ""))
        jvm_e = (F.when(exp_txt != "", exp_txt.try_cast("int"))
                 .when(ip != "0", F.length(ip) - 1)
                 .otherwise(-(lead_zeros + 1)))
        # Older JVMs sometimes print 17-18 digits where fewer round-trip (and 4.9E-324 for 5e-324): for those
        # values only, take the first of 1..17 significant digits that reads back as the same double.
        ax = F.abs(p["x"])
        suspicious = (F.length(jvm_digits) > 15) | ((ax > F.lit(0.0)) & (ax < F.lit(2.3e-308)))
        shortest = F.coalesce(*[
            F.when(F.format_string(f"%.{k - 1}e", ax).try_cast("double") == ax,
                   F.format_string(f"%.{k - 1}e", ax))
            for k in range(1, 18)])
        alt = F.when(suspicious, shortest)
        alt_digits = F.regexp_replace(F.regexp_replace(F.split(alt, "e").getItem(0), r"\.", ""), "0+$", "")
        alt_e = F.split(alt, "e").getItem(1).try_cast("int")
        return F.struct(p["neg"].alias("neg"),
                        F.coalesce(alt_digits, jvm_digits).alias("d"),
                        F.coalesce(alt_e, jvm_e).alias("e"))

    def notation(q: Column) -> Column:
        digits, e = q["d"], q["e"]
        nd = F.length(digits)
        int_part = F.when(nd <= e + 1, F.concat(digits, F.repeat(F.lit("0"), e + 1 - nd))).otherwise(
            F.substring(digits, F.lit(1), e + 1))
        frac_part = F.when(nd <= e + 1, F.lit("0")).otherwise(F.substring(digits, e + 2, nd))
        fixed_pos = F.concat(int_part, F.lit("."), frac_part)
        fixed_neg = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
        sci = F.concat(F.substring(digits, F.lit(1), F.lit(1)),
                       F.when(nd > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), nd))).otherwise(F.lit("")),
                       F.lit("e"), F.when(e < 0, F.lit("-")).otherwise(F.lit("+")),
                       F.when(F.abs(e) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(e).cast("string"))
        finite = (F.when(digits == "", F.lit("0.0"))
                  .when((e >= -4) & (e < 16), F.when(e >= 0, fixed_pos).otherwise(fixed_neg))
                  .otherwise(sci))
        return F.concat(F.when(q["neg"], F.lit("-")).otherwise(F.lit("")), finite)

    rendered = _let(_let(_let(x, jvm_parts), digits_and_exponent), notation)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(x), F.lit("nan"))
            .when(x == F.lit(float("inf")), F.lit("inf"))
            .when(x == F.lit(float("-inf")), F.lit("-inf"))
            .otherwise(rendered))
