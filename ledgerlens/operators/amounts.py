"""Exact amounts.

Amounts arrive as decimal digits of the smallest unit (wei): integers of up to
78 digits, which neither doubles (53 bits) nor DECIMAL(38) hold. For sums, the
digits are cut into limbs of 18 that are summed apart, each with 20 digits to
spare, and carried over once at the end. All of it are built-in expressions with
map-side combining. Results are digit strings; ``value_wei`` is the
DECIMAL(38,0) column for amounts that fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.prepare import q

LIMB_DIGITS = 18
LIMBS = 5  # 90 digits; 2**256 has 78
BASE = f"{10**LIMB_DIGITS}BD"


def _digits(text: Column) -> Column:
    """The digits of an amount; NULL for text that is not one."""
    t = F.trim(text)
    return F.when(t.rlike(r"^[0-9]+$") & (F.length(F.ltrim(t, F.lit("0"))) <= LIMB_DIGITS * LIMBS), t)


def value_wei(text: Column) -> Column:
    """DECIMAL(38,0) of an amount; NULL where it has more digits."""
    return _digits(text).try_cast("decimal(38,0)")


def with_value_wei(raw: DataFrame, col: str = "value") -> DataFrame:
    """Adds ``value_wei`` from the raw text column."""
    return raw.withColumn("value_wei", value_wei(q(col).cast("string")))


def limbs(text: Column) -> Column:
    """An amount as an array of ``LIMBS`` decimals, lowest first; NULL if the
    text is none."""
    width = LIMB_DIGITS * LIMBS
    padded = F.lpad(F.ltrim(_digits(text), F.lit("0")), width, "0")
    parts = [F.substring(padded, width - LIMB_DIGITS * (i + 1) + 1, LIMB_DIGITS).cast("decimal(28,0)") for i in range(LIMBS)]
    return F.when(padded.isNotNull(), F.array(*parts))


def sum_limbs(amount: Column, when: Column | None = None) -> Column:
    """Aggregate: the sums of the limbs of ``amount`` (where ``when`` holds);
    zeros where there is nothing to sum."""
    own = amount if when is None else F.when(when, amount)
    return F.array(*[F.coalesce(F.sum(own[i]), F.lit(0).cast("decimal(38,0)")) for i in range(LIMBS)])


def _carried(sums: Column) -> list[Column]:
    """Limbs below the base, lowest first; the last one carries the sign."""
    out, carry = [], F.lit(0).cast("decimal(38,0)")
    for i in range(LIMBS):
        limb = (sums[i] + carry).cast("decimal(38,0)")
        if i == LIMBS - 1:
            out.append(limb)
            break
        own = F.pmod(limb, F.expr(BASE))
        carry = F.call_function("div", (limb - own).cast("decimal(38,0)"), F.expr(BASE)).cast("decimal(38,0)")
        out.append(own)
    return out


def digits_of(sums: Column) -> Column:
    """The sum as a digit string, with a minus sign if it is below 0."""

    def text(parts: list[Column]) -> Column:
        whole = F.concat(*[F.lpad(p.cast("decimal(38,0)").cast("string"), LIMB_DIGITS, "0") if i else p.cast("string") for i, p in enumerate(reversed(parts))])
        return F.regexp_replace(whole, "^0+(?=.)", "")

    plain = _carried(sums)
    turned = _carried(F.transform(sums, lambda x: (-x).cast("decimal(38,0)")))
    return F.when(plain[-1] < 0, F.concat(F.lit("-"), text(turned))).otherwise(text(plain))


def difference(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: (x - y).cast("decimal(38,0)"))


def daily_tx_stats_wei(tx: DataFrame, amount: str = "value_text") -> DataFrame:
    """Per day: transactions, failed transactions, exact total in wei."""
    rows = tx.select("date", q("isError").try_cast("int").alias("fail"), limbs(q(amount)).alias("amount"))
    days = rows.groupBy("date").agg(
        F.count(F.lit(1)).alias("tx_count"), F.sum("fail").cast("bigint").alias("failed_tx"), sum_limbs(q("amount")).alias("total")
    )
    return days.select("date", "tx_count", "failed_tx", digits_of(q("total")).alias("total_wei"))


def address_amounts_wei(tx: DataFrame, amount: str = "value_text") -> DataFrame:
    """Per address: exact amounts sent and received, and received less sent."""
    sides = F.array(
        F.struct(q("from").alias("address"), F.lit(True).alias("sent")),
        F.struct(q("to").alias("address"), F.lit(False).alias("sent")),
    )
    rows = tx.select(F.explode(sides).alias("s"), q(amount).alias("amount")).select("s.address", "s.sent", limbs(q("amount")).alias("amount"))
    sums = rows.filter(q("address").isNotNull()).groupBy("address").agg(
        F.count(F.when(q("sent"), 1)).alias("sent_count"),
        sum_limbs(q("amount"), q("sent")).alias("out"),
        sum_limbs(q("amount"), ~q("sent")).alias("in"),
    )
    return sums.select(
        "address",
        "sent_count",
        digits_of(q("out")).alias("sent_wei"),
        digits_of(q("in")).alias("received_wei"),
        digits_of(difference(q("in"), q("out"))).alias("net_wei"),
    )
