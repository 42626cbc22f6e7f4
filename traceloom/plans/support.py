"""Queries over the example store, on customers and orders; refunds and tickets are asked for by a rule of the keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from traceloom.operators import support as C
from traceloom.plans.registered import query
from traceloom.sources.tables import read_table


def customers(spark, d):
    return read_table(spark, d, "customer", F.col("c_custkey").alias("id"), F.concat(F.lower("c_name"), F.lit("@x.org")).alias("email"), F.col("c_name").alias("name"), F.concat(F.lit(" nation "), F.col("c_nationkey").cast("string")).alias("address"), F.col("c_mktsegment").alias("tier"))


def orders(spark, d):
    status = F.when(F.col("o_orderstatus") == "O", "processing").when(F.col("o_orderkey") % 50 == 0, "shipped").otherwise("delivered")
    return read_table(spark, d, "orders", F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"), status.alias("status"), F.col("o_totalprice").alias("total"), F.col("o_orderdate").alias("placed_on"), C.tracking_id(F.col("o_orderkey")).alias("tracking"))


def refunds(spark, d):
    return spark.createDataFrame([("r_1_1", 1, 5.0, "late"), ("r_3_1", 3, 2.5, "late"), ("r_3_2", 3, 1.25, "late")], "id string, order_id long, amount double, reason string")


_ORDERS = """v_orders as (select o_orderkey as id, o_custkey as customer_id, case when o_orderstatus = 'O' then 'processing' when o_orderkey % 50 = 0 then 'shipped' else 'delivered' end as status, o_totalprice as total, o_orderdate as placed_on,
  '1Z' || lpad((cast('0x' || substr(sha256(o_orderkey::varchar), 1, 12) as bigint) % 10000000000)::varchar, 10, '0') as tracking from orders)"""
_REFUNDS = "v_refunds(id, order_id, amount) as (values ('r_1_1', 1, 5.0), ('r_3_1', 3, 2.5), ('r_3_2', 3, 1.25))"


@query("tracking_ids", f"with {_ORDERS} select id, tracking from v_orders")
def tracking_ids(spark, d):
    return orders(spark, d).select("id", "tracking")


@query("tool_get_customer", "select l_orderkey * 10 + l_linenumber as seq, c.c_custkey as customer_id, case when c.c_custkey is null then 'no such customer' end as refusal from (select distinct l_orderkey, l_linenumber from lineitem) l left join customer c on c.c_name = 'Customer#' || lpad(l.l_orderkey::varchar, 9, '0')")
def tool_get_customer(spark, d):
    asked = read_table(spark, d, "lineitem", "l_orderkey", "l_linenumber").distinct()
    email = F.concat(F.lit(" CUSTOMER#"), F.lpad(F.col("l_orderkey").cast("string"), 9, "0"), F.lit("@x.org "))
    return C.get_customers(customers(spark, d), asked.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), email.alias("email"))).select("seq", "customer_id", "refusal")


@query("tool_list_orders", f"with {_ORDERS} select c_custkey as seq, list(o.id order by placed_on desc, o.id) filter (where o.id is not null) as orders from customer c left join v_orders o on o.customer_id = c_custkey and status = 'delivered' group by 1 having count(o.id) > 0")
def tool_list_orders(spark, d):
    asked = read_table(spark, d, "customer", F.col("c_custkey").alias("seq"), F.col("c_custkey").alias("customer_id")).withColumn("status", F.lit("delivered"))
    return C.list_orders(orders(spark, d), customers(spark, d), asked).where(F.size("orders") > 0).select("seq", "orders")


@query("tool_get_order", f"with {_ORDERS}, {_REFUNDS}, a as (select distinct l_partkey as k from lineitem) select k as seq, o.id as order_id, case when o.id is not null then coalesce((select sum(amount) from v_refunds r where r.order_id = o.id), 0)::double end as refunded_so_far, case when o.id is null then 'no such order' end as refusal from a left join v_orders o on o.id = a.k")
def tool_get_order(spark, d):
    asked = read_table(spark, d, "lineitem", "l_partkey").distinct().select(F.col("l_partkey").alias("seq"), F.col("l_partkey").alias("order_id"))
    out = C.get_orders(orders(spark, d), refunds(spark, d), asked)
    return out.select("seq", F.when(F.col("refusal").isNull(), F.col("order_id")).alias("order_id"), "refunded_so_far", "refusal")


@query("tool_issue_refund", f"""with {_ORDERS}, {_REFUNDS}, a as (select event_id as seq, user_id * 7 as order_id, value * 1000 - 3000 as amount, case when event_id % 5 = 0 then 'whim' else 'late' end as reason from events),
 x as (select a.*, o.status, o.total, exists (select 1 from v_refunds r where r.order_id = a.order_id) as before from a left join v_orders o on o.id = a.order_id),
 y as (select *, case when status is null then 'no such order' when reason = 'whim' then 'unknown reason' when status not in ('shipped', 'delivered') then 'not refundable' end as e, case when amount <= 0 then 'not positive' when round(amount, 2) > round(total, 2) then 'above the total' end as l from x),
 z as (select *, min(case when e is null and l is null and not before then seq end) over (partition by order_id) as f from y)
select seq, coalesce(e, case when before or seq > f then 'already refunded' end, l) as refusal from z""")
def tool_issue_refund(spark, d):
    e = read_table(spark, d, "events", "event_id", "user_id", "value")
    asked = e.select(F.col("event_id").alias("seq"), (F.col("user_id") * 7).alias("order_id"), (F.col("value") * 1000 - 3000).alias("amount"), F.when(F.col("event_id") % 5 == 0, "whim").otherwise("late").alias("reason"))
    return C.issue_refunds(orders(spark, d), refunds(spark, d), asked)[1].select("seq", "refusal")


@query("tool_update_address", f"with {_ORDERS}, s as (select customer_id, min(id) as o from v_orders where status = 'shipped' group by 1) select e.event_id as seq, case when c.c_custkey is null then 'no such customer' when s.o is not null then 'already shipped: ' || s.o end as refusal from events e left join customer c on c.c_custkey = e.user_id left join s on s.customer_id = e.user_id")
def tool_update_address(spark, d):
    asked = read_table(spark, d, "events", F.col("event_id").alias("seq"), F.col("user_id").alias("customer_id"), F.concat(F.col("event_type"), F.lit(" street ")).alias("address"))
    return C.update_addresses(customers(spark, d), orders(spark, d), asked)[1].select("seq", "refusal")


@query("tool_create_ticket", """with x as (select event_id as seq, case when c.c_custkey is null then 'no such customer' when event_type = 'view' then 'unknown category' end as refusal from events e left join customer c on c.c_custkey = e.user_id)
select seq, refusal, case when refusal is null then 't_' || (count(*) filter (where refusal is null) over (order by seq)) end as ticket_id from x""")
def tool_create_ticket(spark, d):
    asked = read_table(spark, d, "events", F.col("event_id").alias("seq"), F.col("user_id").alias("customer_id"), F.when(F.col("event_type") == "view", "none").otherwise("billing").alias("category"), F.col("event_type").alias("summary"))
    none = spark.createDataFrame([], "id string, customer_id long, category string, summary string")
    return C.create_tickets(none, customers(spark, d), asked)[1].select("seq", "refusal", "ticket_id")


def end_states(spark, d):
    """Customers as tasks: their first order by price is refunded if it is cheap, a ticket is open in one segment."""
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_totalprice").groupBy(F.col("o_custkey").alias("k")).agg(F.min(F.struct("o_totalprice", "o_orderkey")).alias("o"))
    c = read_table(spark, d, "customer", "c_custkey", "c_mktsegment", "c_nationkey").join(o, F.col("c_custkey") == F.col("k"))
    refund = F.when(F.col("o.o_totalprice") < 50000, F.array(F.struct(F.col("o.o_orderkey").alias("order_id"), F.col("o.o_totalprice").alias("amount")))).otherwise(F.array().cast("array<struct<order_id:bigint,amount:double>>"))
    ticket = F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.struct(F.col("c_custkey").alias("customer_id"), F.lit("billing").alias("category")))).otherwise(F.array().cast("array<struct<customer_id:bigint,category:string>>"))
    reply = F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("Refunded $"), F.format_string("%.2f", "o.o_totalprice"), F.lit(", status delivered")))
    return c.select(F.col("c_custkey").alias("task_id"), F.col("o.o_orderkey").alias("order_id"), F.col("o.o_totalprice").alias("amount"), refund.alias("refunds"), ticket.alias("tickets"), (F.col("c_nationkey") == 3).alias("moved"), reply.alias("reply"))


_STATES = "v_state as (select c_custkey as task_id, min(o_totalprice) < 50000 as r, c_mktsegment = 'BUILDING' as t, c_nationkey = 3 as m, c_nationkey % 2 = 0 as said from customer join orders on o_custkey = c_custkey group by c_custkey, c_mktsegment, c_nationkey)"


@query("state_predicates", f"""with {_STATES}, e as (select *, case when r then 'a refund' when t then 'a ticket' when m then 'an address' end as side from v_state)
select task_id, case when not r then 'no refund' when not said then 'amount not said' end as refund_exactly, side as no_side_effects, coalesce(side, case when not said then 'no reply' end) as nothing_changed,
 case when not t then 'no ticket' when r then 'a refund' when m then 'an address' end as ticket_opened, coalesce(side, case when not said then 'status not said' end) as status_reported,
 case when not r then 'not refunded' end as refund_one_of_two, case when r then 'a refund' when m then 'an address' when not said then 'no reply' end as refused_and_explained,
 case when not r then 'missing' end as refunds_exactly, case when not r then 'no refund' when not said then 'amount not said' end as refund_at_most, coalesce(side, case when not said then 'tracking not said' end) as tracking_reported from e""")
def state_predicates(spark, d):
    k, amount = F.col("order_id"), F.col("amount")
    checks = {
        "refund_exactly": C.refund_exactly(k, amount), "no_side_effects": C.no_side_effects(), "nothing_changed": C.nothing_changed(), "ticket_opened": C.ticket_opened(F.col("task_id"), F.lit("billing")),
        "status_reported": C.status_reported(F.lit("Delivered")), "refund_one_of_two": C.refund_one_of_two(k, F.lit(-1), amount), "refused_and_explained": C.refused_and_explained(["refunded"], True),
        "refunds_exactly": C.refunds_exactly(F.array(F.struct(k.alias("order_id"), amount.alias("amount")))), "refund_at_most": C.refund_at_most(k, amount), "tracking_reported": C.tracking_reported(F.lit("Refunded"), F.lit("delivered")),
    }
    return end_states(spark, d).select("task_id", *(c.alias(n) for n, c in checks.items()))


_TRAJECTORY = """o as (select o_custkey as k, o_orderkey as id, case o_orderstatus when 'F' then 'delivered' when 'O' then 'placed' else 'shipped' end as status, o_totalprice as total from orders),
 r as (select k, id, status, total, unnest([1, 2]) as try from o), q as (select *, case when try = 1 then floor(total * (0.5 + (id % 4) / 4.0)) else total end as amount, case when id % 5 = 0 and try = 1 then 'mood' else 'late' end as reason from r),
 f as (select *, reason = 'late' and status in ('shipped', 'delivered') and round(amount, 2) <= round(total, 2) as fine from q),
 g as (select *, case when fine and row_number() over (partition by id, fine order by try) = 1 then round(amount, 2) end as paid from f),
 a as (select k, count(*) as n, count(paid) as granted, coalesce(round(sum(paid), 2), 0) as back, count(distinct id) filter (where status = 'shipped') as on_way from g group by k),
 c as (select c_custkey as k, c_name, c_mktsegment = 'BUILDING' as known from customer)"""


@query("replay_grading", f"""with {_TRAJECTORY} select k as task_id, (n + 3)::int as n_calls_applied, (n - granted + 1 + (on_way > 0)::int + (not known)::int)::int as n_calls_refused, granted::int as refunds, back, known::int as tickets,
 case when on_way > 0 then c_name else 'new street' end as address from a join c using (k)""")
def replay_grading(spark, d):
    """End states and refusals of a trajectory a customer: two refund tries for each order, an unknown tool, a ticket, and a new address."""
    o = read_table(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    status = F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "placed").otherwise("shipped")
    own = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), status.alias("status"), F.col("o_totalprice").cast("double").alias("total")))).alias("orders"))
    no = lambda t: F.lit(None).cast(t)
    call = lambda tool, order=None, amount=None, reason=None, who=None, category=None, address=None: F.struct(
        F.lit(tool).alias("tool"), (no("bigint") if order is None else order).alias("order_id"), (no("bigint") if who is None else who).alias("customer_id"), (no("double") if amount is None else amount).alias("amount"),
        (no("string") if reason is None else reason).alias("reason"), (no("string") if category is None else category).alias("category"), (no("string") if address is None else address).alias("address"),
    )
    first = F.transform("orders", lambda x: call("issue_refund", x["id"], F.floor(x["total"] * (0.5 + (x["id"] % 4) / 4.0)).cast("double"), F.when(x["id"] % 5 == 0, "mood").otherwise("late")))
    second = F.transform("orders", lambda x: call("issue_refund", x["id"], x["total"], F.lit("late")))
    k = F.col("c_custkey").cast("bigint")
    rest = F.array(call("close_account"), call("create_ticket", who=k, category=F.when(F.col("c_mktsegment") == "BUILDING", "billing").otherwise("weather")), call("update_address", who=k, address=F.lit(" new street ")))
    tasks = own.join(read_table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    ends = C.graded_replays(tasks.select(F.col("c_custkey").alias("task_id"), k.alias("customer_id"), F.col("c_name").alias("address"), "orders", F.concat(first, second, rest).alias("calls")))
    back = F.round(F.aggregate("refunds", F.lit(0.0), lambda s, x: s + x["amount"]), 2)
    return ends.select("task_id", "n_calls_applied", "n_calls_refused", F.size("refunds").alias("refunds"), back.alias("back"), F.size("tickets").alias("tickets"), "address")


@query("address_predicates", """select c_custkey as task_id, case when c_nationkey = 3 then 'wrong address' when c_mktsegment = 'BUILDING' then 'a ticket' end as updated, case when c_nationkey = 3 then 'address changed' when c_mktsegment <> 'BUILDING' then 'no ticket' end as kept,
 case when c_nationkey = 3 then 'wrong address' when c_mktsegment = 'BUILDING' then 'a ticket' else 'no ticket' end as both_ from customer""")
def address_predicates(spark, d):
    c = read_table(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    ticket = F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.struct(F.col("c_custkey").alias("customer_id"), F.lit("x").alias("category")))).otherwise(F.array().cast("array<struct<customer_id:bigint,category:string>>"))
    s = c.select(F.col("c_custkey").alias("task_id"), ticket.alias("tickets"), F.when(F.col("c_nationkey") == 3, "elsewhere").otherwise("Main street ").alias("now"))
    up, kept = C.address_updated(F.col("now"), F.lit("main street")), C.address_kept_and_ticket(F.col("now"), F.lit("Main street"))
    return s.select("task_id", up.alias("updated"), kept.alias("kept"), C.all_of(up, kept).alias("both_"))


@query("corpus_summary", "select c_mktsegment, count(*) as n, round(avg((c_acctbal > 0)::int), 6) as success, sum(c_nationkey)::bigint as prompt_tokens, sum(c_custkey)::bigint as completion_tokens from customer group by 1")
def corpus_summary(spark, d):
    c = read_table(spark, d, "customer", "c_mktsegment", (F.col("c_acctbal") > 0).alias("success"), F.col("c_nationkey").alias("prompt_tokens"), F.col("c_custkey").alias("completion_tokens"))
    out = C.corpus_summary(c, "c_mktsegment")
    return out.select("c_mktsegment", "n", F.round("success", 6).alias("success"), "prompt_tokens", "completion_tokens")
