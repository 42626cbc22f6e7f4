"""Cost model: dollars per million tokens and per task, break-even and saving, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def student_per_mtok(gpu_hour, tokens_per_second, utilization=0.6) -> Column:
    """Infinite where nothing is generated."""
    rate = tokens_per_second * utilization
    return F.when(rate > 0, gpu_hour / (rate * 3600) * 1e6).otherwise(float("inf"))


def teacher_per_task(prompt, completion, input_price, output_price, hit_share=None, read_price=None) -> Column:
    """With cached prompt tokens at their own price, or at the input price where it isn't known."""
    hit = F.coalesce(hit_share, F.lit(0.0)) if hit_share is not None else F.lit(0.0)
    read = F.coalesce(read_price, input_price) if read_price is not None else input_price
    return (prompt * (1 - hit) * input_price + prompt * hit * read + completion * output_price) / 1e6


def cascade_per_task(student_tokens, per_mtok, escalation, teacher_cost, wasted=0.0) -> Column:
    """Discarded student tokens are paid for as well."""
    return (student_tokens + wasted) * per_mtok / 1e6 + escalation * teacher_cost


def breakeven_per_day(gpu_hour, teacher_cost, variable_cost) -> Column:
    """Tasks a day at which the machine pays for itself; infinite without a saving."""
    saving = teacher_cost - variable_cost
    return F.when(saving > 0, gpu_hour * 24 / saving).otherwise(float("inf"))


def saving(teacher_cost, cascade_cost) -> Column:
    """Share saved; null where the teacher's cost is unknown or zero."""
    return F.when(teacher_cost != 0, 1 - cascade_cost / teacher_cost)
