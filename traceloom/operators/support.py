"""The example store of a support desk: its tools over whole tables of requests, and predicates over end states.

Tables: customers (id, email, name, address, tier), orders (id, customer_id, status, total, item, placed_on, carrier, tracking),
refunds (id, order_id, amount, reason), tickets (id, customer_id, category, summary). A tool takes a table of requests and
answers them all; requests that write have a number ``seq`` and take effect in its order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from traceloom.operators.ordered import running

# What the store accepts.
REASONS = ("damaged", "late", "wrong_item", "unwanted")
CATEGORIES = ("billing", "shipping", "product", "other")
REFUNDABLE = ("shipped", "delivered")


def tracking_id(order_id: Column) -> Column:
    """A tracking number that depends on the order alone, on every machine."""
    n = F.conv(F.substring(F.sha2(order_id.cast("string"), 256), 1, 12), 16, 10).cast("long") % 10_000_000_000
    return F.concat(F.lit("1Z"), F.lpad(n.cast("string"), 10, "0"))


def get_customers(customers: DataFrame, asked: DataFrame) -> DataFrame:
    """``seq, customer_id, name, address, tier, refusal`` for each asked email, whatever its case."""
    c = customers.select(F.lower("email").alias("_e"), F.col("id").alias("customer_id"), "name", "address", "tier")
    found = asked.withColumn("_e", F.lower(F.trim("email"))).join(c, "_e", "left")
    return found.select("seq", "customer_id", "name", "address", "tier", F.when(F.col("customer_id").isNull(), "no such customer").alias("refusal"))


def list_orders(orders: DataFrame, customers: DataFrame, asked: DataFrame) -> DataFrame:
    """``seq, orders, refusal``: each asked customer's orders (of a status, if one is given), newest first, then by id."""
    known = asked.join(customers.select(F.col("id").alias("customer_id"), F.lit(True).alias("known")), "customer_id", "left")
    o = orders.select("customer_id", F.col("id").alias("order_id"), F.col("status").alias("s"), "placed_on")
    hit = known.join(o, "customer_id", "left").where(F.col("status").isNull() | F.col("s").isNull() | (F.col("status") == F.col("s")))
    place = F.struct((-F.unix_micros(F.col("placed_on").cast("timestamp"))).alias("t"), F.col("order_id"))
    listed = hit.where("order_id is not null").groupBy("seq").agg(F.transform(F.array_sort(F.collect_list(place)), lambda x: x["order_id"]).alias("orders"))
    out = known.select("seq", "known").join(listed, "seq", "left")
    return out.select("seq", F.when(F.col("known"), F.coalesce("orders", F.array().cast(listed.schema["orders"].dataType))).alias("orders"), F.when(F.col("known").isNull(), "no such customer").alias("refusal"))


def get_orders(orders: DataFrame, refunds: DataFrame, asked: DataFrame) -> DataFrame:
    """``seq, order_id, status, total, tracking, refunded_so_far, refusal`` of each asked order."""
    back = refunds.groupBy("order_id").agg(F.round(F.sum("amount"), 2).alias("back"))
    o = orders.select(F.col("id").alias("order_id"), "status", "total", "tracking", F.lit(True).alias("known"))
    out = asked.join(o, "order_id", "left").join(back, "order_id", "left")
    return out.select("seq", "order_id", "status", "total", "tracking", F.when(F.col("known"), F.coalesce("back", F.lit(0.0))).alias("refunded_so_far"), F.when(F.col("known").isNull(), "no such order").alias("refusal"))


def issue_refunds(orders: DataFrame, refunds: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(refunds, answers): each request (seq, order_id, amount, reason) with its refusal or null. Of the requests for an order that
    nothing else speaks against the first is granted; an order is refunded once."""
    o = orders.select(F.col("id").alias("order_id"), "status", "total")
    before = refunds.select("order_id").distinct().withColumn("before", F.lit(True))
    x = asked.join(o, "order_id", "left").join(before, "order_id", "left")
    money = (
        F.when(F.col("status").isNull(), "no such order").when(~F.col("reason").isin(*REASONS), "unknown reason").when(~F.col("status").isin(*REFUNDABLE), "not refundable")
    )
    late = F.when(F.col("amount") <= 0, "not positive").when(F.round("amount", 2) > F.round("total", 2), "above the total")
    x = x.withColumns({"_early": money, "_late": late})
    fine = F.col("_early").isNull() & F.col("_late").isNull() & F.col("before").isNull()
    x = x.withColumn("_first", F.min(F.when(fine, F.col("seq"))).over(Window.partitionBy("order_id")))
    done = F.col("before").isNotNull() | (F.col("seq") > F.col("_first"))
    refusal = F.coalesce(F.col("_early"), F.when(done, "already refunded"), F.col("_late"))
    answers = x.select("seq", "order_id", F.round("amount", 2).alias("amount"), "reason", refusal.alias("refusal"))
    new = answers.where("refusal is null").select(F.concat(F.lit("r_"), F.col("order_id").cast("string"), F.lit("_1")).alias("id"), "order_id", "amount", "reason")
    return refunds.unionByName(new), answers


STATE = "struct<orders:array<struct<id:bigint,status:string,total:double>>,refunds:array<struct<order_id:bigint,amount:double,reason:string>>,tickets:array<struct<customer_id:bigint,category:string>>,address:string,log:array<struct<tool:string,refusal:string>>>"
CALL = "struct<tool:string,order_id:bigint,customer_id:bigint,amount:double,reason:string,category:string,address:string>"


def apply_call(state: Column, call: Column, customer: Column) -> Column:
    """The state after one call of one customer's task, and what the call was told: a refused call changes nothing but the log."""
    order = F.get(F.filter(state["orders"], lambda o: o["id"] == call["order_id"]), F.lit(0))
    again = F.exists(state["refunds"], lambda r: r["order_id"] == call["order_id"])
    refund = (
        F.when(order["id"].isNull(), "no such order").when(~F.coalesce(call["reason"].isin(*REASONS), F.lit(False)), "unknown reason").when(~order["status"].isin(*REFUNDABLE), "not refundable")
        .when(again, "already refunded").when(F.coalesce(call["amount"] <= 0, F.lit(True)), "not positive").when(F.round(call["amount"], 2) > F.round(order["total"], 2), "above the total")
    )
    own = F.coalesce(call["customer_id"] == customer, F.lit(False))
    ticket = F.when(~own, "no such customer").when(~F.coalesce(call["category"].isin(*CATEGORIES), F.lit(False)), "unknown category")
    on_way = F.array_min(F.transform(F.filter(state["orders"], lambda o: o["status"] == "shipped"), lambda o: o["id"]))
    move = F.when(~own, "no such customer").when(on_way.isNotNull(), F.concat(F.lit("already shipped: "), on_way.cast("string")))
    look = F.when(call["tool"].isin("get_order") & order["id"].isNull(), "no such order").when(call["tool"].isin("get_customer", "list_orders") & ~own, "no such customer")
    known = call["tool"].isin("issue_refund", "create_ticket", "update_address", "get_order", "get_customer", "list_orders")
    refusal = F.when(~F.coalesce(known, F.lit(False)), "no such tool").when(call["tool"] == "issue_refund", refund).when(call["tool"] == "create_ticket", ticket).when(call["tool"] == "update_address", move).otherwise(look)
    done = lambda tool: (call["tool"] == tool) & refusal.isNull()
    paid = F.array(F.struct(call["order_id"].alias("order_id"), F.round(call["amount"], 2).alias("amount"), call["reason"].alias("reason")))
    opened = F.array(F.struct(call["customer_id"].alias("customer_id"), call["category"].alias("category")))
    return F.struct(
        state["orders"].alias("orders"), F.when(done("issue_refund"), F.concat(state["refunds"], paid)).otherwise(state["refunds"]).alias("refunds"),
        F.when(done("create_ticket"), F.concat(state["tickets"], opened)).otherwise(state["tickets"]).alias("tickets"), F.when(done("update_address"), F.trim(call["address"])).otherwise(state["address"]).alias("address"),
        F.concat(state["log"], F.array(F.struct(call["tool"].alias("tool"), refusal.alias("refusal")))).alias("log"),
    ).cast(STATE)


def graded_replays(tasks: DataFrame) -> DataFrame:
    """End states of trajectories, one fold of their calls a row: ``tasks(task_id, customer_id, address, orders, calls)`` with orders and calls as in STATE
    and CALL, calls in order. Adds ``refunds, tickets, address, log, n_calls_applied, n_calls_refused, state_hash``; a null ``calls`` counts as none.

    A task's store is its customer's, so a trajectory needs no other row: nothing is shuffled."""
    none = lambda t: F.array().cast(t)
    start = F.struct(
        F.coalesce("orders", none("array<struct<id:bigint,status:string,total:double>>")).alias("orders"), none("array<struct<order_id:bigint,amount:double,reason:string>>").alias("refunds"),
        none("array<struct<customer_id:bigint,category:string>>").alias("tickets"), F.col("address"), none("array<struct<tool:string,refusal:string>>").alias("log"),
    ).cast(STATE)
    calls = F.coalesce("calls", none(f"array<{CALL}>")).cast(f"array<{CALL}>")
    end = tasks.withColumn("_end", F.aggregate(calls, start, lambda s, c: apply_call(s, c, F.col("customer_id"))))
    state = F.struct(F.col("_end.address").alias("address"), F.array_sort("_end.refunds").alias("refunds"), F.array_sort("_end.tickets").alias("tickets"))
    refused = F.size(F.filter("_end.log", lambda x: x["refusal"].isNotNull()))
    return end.select("task_id", "customer_id", F.col("_end.refunds").alias("refunds"), F.col("_end.tickets").alias("tickets"), F.col("_end.address").alias("address"), F.col("_end.log").alias("log"), F.size("_end.log").alias("n_calls_applied"), refused.alias("n_calls_refused"), F.sha2(F.to_json(state), 256).alias("state_hash"))


def update_addresses(customers: DataFrame, orders: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(customers, answers): addresses change, the last request counts; refused while an order of the customer is on its way."""
    on_way = orders.where("status = 'shipped'").groupBy("customer_id").agg(F.min("id").alias("order_id"))
    x = asked.join(customers.select(F.col("id").alias("customer_id"), F.lit(True).alias("known")), "customer_id", "left").join(on_way, "customer_id", "left")
    refusal = F.when(F.col("known").isNull(), "no such customer").when(F.col("order_id").isNotNull(), F.concat(F.lit("already shipped: "), F.col("order_id").cast("string")))
    answers = x.select("seq", "customer_id", F.trim("address").alias("address"), refusal.alias("refusal"))
    last = answers.where("refusal is null").groupBy("customer_id").agg(F.max_by("address", "seq").alias("new"))
    moved = customers.join(last, customers["id"] == last["customer_id"], "left").withColumn("address", F.coalesce("new", "address"))
    return moved.select(*customers.columns), answers


def create_tickets(tickets: DataFrame, customers: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tickets, answers): accepted requests get the next numbers, in order of seq."""
    x = asked.join(customers.select(F.col("id").alias("customer_id"), F.lit(True).alias("known")), "customer_id", "left")
    refusal = F.when(F.col("known").isNull(), "no such customer").when(~F.col("category").isin(*CATEGORIES), "unknown category")
    x = x.withColumn("refusal", refusal)
    n = tickets.agg(F.count(F.lit(1)).alias("n"))
    counted = running(x, [], ["seq"], F.col("refusal").isNull().cast("int"), "k").join(F.broadcast(n), how="cross")  # one row
    answers = counted.select("seq", "customer_id", "category", "summary", "refusal", F.when(F.col("refusal").isNull(), F.concat(F.lit("t_"), (F.col("n") + F.col("k") + 1).cast("string"))).alias("ticket_id"))
    new = answers.where("refusal is null").select(F.col("ticket_id").alias("id"), "customer_id", "category", "summary")
    return tickets.unionByName(new), answers


def state_hash(*tables: DataFrame) -> DataFrame:
    """First 16 hex digits of sha256 over all tables, each row as JSON in order of its id."""
    out = None
    for i, t in enumerate(tables):
        part = t.select(F.lit(i).alias("t"), F.to_json(F.struct(*sorted(t.columns))).alias("j"))
        out = part if out is None else out.union(part)
    h = out.select("t", F.sha2("j", 256).alias("h"))
    by = h.groupBy("t", F.substring("h", 1, 3).alias("p")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("h"))
    return by.agg(F.substring(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", "p", "h"))), lambda x: x["h"]), ""), 256), 1, 16).alias("state_hash"))


# Predicates: each gives why the end state of a task fails, null if it passes. An end state has columns refunds (array of order_id,
# amount), tickets (array of customer_id, category), moved (an address changed) and reply.
def _refunds() -> Column:
    return F.col("refunds")


def _tickets() -> Column:
    return F.col("tickets")


def _said() -> Column:
    return F.coalesce(F.col("reply"), F.lit(""))


def money_said(amount: Column) -> Column:
    """Whether the reply states an amount, with or without thousands separators."""
    return F.contains(F.regexp_replace(_said(), ",", ""), F.format_string("%.2f", amount.cast("double")))


def mentions(what: Column) -> Column:
    return F.contains(F.lower(_said()), F.lower(what))


def _one_refund(order_id: Column) -> Column:
    return F.when(F.size(_refunds()) == 0, "no refund").when(F.size(_refunds()) > 1, "several refunds").when(_refunds()[0]["order_id"] != order_id, "wrong order")


def refund_exactly(order_id: Column, amount: Column, say: bool = True) -> Column:
    why = _one_refund(order_id).when(F.round(_refunds()[0]["amount"], 2) != F.round(amount, 2), "wrong amount")
    return why.when(~money_said(amount), "amount not said") if say else why


def refund_at_most(order_id: Column, ceiling: Column) -> Column:
    x = _refunds()[0]["amount"]
    return _one_refund(order_id).when((x <= 0) | (x > F.round(ceiling, 2) + 1e-9), "outside the total").when(~money_said(x), "amount not said")


def refunds_exactly(expected: Column) -> Column:
    """``expected``: an array of (order_id, amount)."""
    ids = lambda a: F.transform(a, lambda x: x["order_id"])
    cents = lambda a: F.array_sort(F.transform(a, lambda x: F.concat_ws("=", x["order_id"].cast("string"), F.round(x["amount"] * 100).cast("long").cast("string"))))
    return F.when(F.size(F.array_except(ids(expected), ids(_refunds()))) > 0, "missing").when(F.size(F.array_except(ids(_refunds()), ids(expected))) > 0, "not asked for").when(cents(_refunds()) != cents(expected), "wrong amount")


def no_side_effects() -> Column:
    return F.when(F.size(_refunds()) > 0, "a refund").when(F.size(_tickets()) > 0, "a ticket").when(F.col("moved"), "an address")


def nothing_changed() -> Column:
    return F.coalesce(no_side_effects(), F.when(F.trim(_said()) == "", "no reply"))


def refused_and_explained(must_mention: list[str], allow_ticket: bool = False) -> Column:
    why = F.when(F.size(_refunds()) > 0, "a refund").when((F.size(_tickets()) > 0) & F.lit(not allow_ticket), "a ticket").when(F.col("moved"), "an address").when(F.trim(_said()) == "", "no reply")
    for m in must_mention:
        why = why.when(~mentions(F.lit(m)), "not explained")
    return why


def address_updated(now: Column, wanted: Column) -> Column:
    return F.when(now.isNull(), "no customer").when(F.lower(F.trim(now)) != F.lower(F.trim(wanted)), "wrong address").when(F.size(_tickets()) > 0, "a ticket")


def address_kept_and_ticket(now: Column, original: Column) -> Column:
    return F.when(now.isNull(), "no customer").when(F.trim(now) != F.trim(original), "address changed").when(F.size(_tickets()) == 0, "no ticket")


def ticket_opened(customer_id: Column, category: Column) -> Column:
    mine = F.filter(_tickets(), lambda t: t["customer_id"] == customer_id)
    return F.when(F.size(mine) == 0, "no ticket").when(F.size(_tickets()) > 1, "several tickets").when(mine[0]["category"] != category, "wrong category").when(F.size(_refunds()) > 0, "a refund").when(F.col("moved"), "an address")


def tracking_reported(tracking: Column, carrier: Column) -> Column:
    return no_side_effects().when(tracking.isNull(), "no tracking number").when(~mentions(tracking), "tracking not said").when(carrier.isNotNull() & ~mentions(carrier), "carrier not said")


def status_reported(status: Column) -> Column:
    return no_side_effects().when(~mentions(status), "status not said")


def refund_one_of_two(eligible: Column, other: Column, amount: Column) -> Column:
    ids = F.transform(_refunds(), lambda x: x["order_id"])
    return F.when(F.array_contains(ids, other), "the other order").when(~F.array_contains(ids, eligible), "not refunded").when(F.size(_refunds()) != 1, "several refunds").when(F.round(_refunds()[0]["amount"], 2) != F.round(amount, 2), "wrong amount")


def all_of(*whys: Column) -> Column:
    """The first predicate that fails."""
    return F.coalesce(*whys)


def corpus_summary(traces: DataFrame, by: str) -> DataFrame:
    """Traces, success rate and token sums by scenario."""
    return traces.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg(F.coalesce(F.col("success").cast("double"), F.lit(0.0))).alias("success"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"))
