"""Whole jobs over decoded records: comparison with a vendor file."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions.fields import fixed_decimal, or_question_mark, tick_time_text
from quotemill.operators.reconcile import FIELDS, reconcile, reconcile_summary
from quotemill.session import staged
from quotemill.sources.tables import write_reconcile

KEYS = ["channel", "biz_index"]
EXACT = "decimal(20,5)"


def _comparable(rows: DataFrame) -> DataFrame:
    """Vendor columns brought to one form: times to the second, exact numbers, ``?`` for empty text."""
    compared = {
        "tick_second": F.substring("tick_time", 1, 8),
        "action": or_question_mark(F.col("action")),
        "bs_flag": or_question_mark(F.col("bs_flag")),
        "price": F.col("price").cast(EXACT),
        "qty": F.col("qty").cast(EXACT),
        "money": F.col("money").cast(EXACT),
        "buy_order_no": F.col("buy_order_no").cast("long"),
        "sell_order_no": F.col("sell_order_no").cast("long"),
    }
    typed = rows.withColumns(compared | {k: F.col(k).cast("long") for k in KEYS})
    # Rows of one key pair by time and content, which both sides have; an hour is a block of a key.
    return typed.select(*KEYS, *FIELDS, "tick_time", F.substring("tick_time", 1, 2).alias("tick_hour"))


def verify_ticks(decoded: DataFrame, vendor: DataFrame) -> DataFrame:
    """Decoded ticks against rows of ``read_ticks_csv``: one row per key and occurrence with its status.

    Vendor times may carry two or three digits of a second; rows that did not parse are left out.
    """
    scaled = decoded.withColumns(
        {
            "tick_time": tick_time_text(F.col("tick_time")),
            "price": fixed_decimal(F.col("price_e3"), 3),
            "qty": fixed_decimal(F.col("qty_e3"), 3),
            "money": fixed_decimal(F.col("money_e5"), 5),
        }
    )
    parsed = vendor.filter(F.col("_corrupt_record").isNull()) if "_corrupt_record" in vendor.columns else vendor
    order = ["tick_time", "security_id", "price", "qty", "money"]
    # Written once: counting keys and comparing would decode twice.
    ours, theirs = staged(_comparable(scaled), "decoded-ticks"), staged(_comparable(parsed), "vendor-ticks")
    return reconcile(ours, theirs, key=KEYS, block=["tick_hour"], order=order)


def verify_to(decoded: DataFrame, vendor: DataFrame, folder: str) -> DataFrame:
    """Write the comparison, one folder per status, and return the counts of what was written."""
    write_reconcile(verify_ticks(decoded, vendor), folder)
    written = decoded.sparkSession.read.parquet(folder)
    return reconcile_summary(written)
