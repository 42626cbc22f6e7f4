"""End states of trajectories against a plain walk over their calls."""

import random

from traceloom.operators import support as C


def walk(task):
    """One trajectory in plain Python: refunds, tickets, address and refusals in order."""
    _, who, address, orders, calls = task
    refunds, tickets, log = [], [], []
    for tool, order_id, customer, amount, reason, category, new in calls or []:
        order = next((o for o in orders or [] if o[0] == order_id), None)
        why = None
        if tool == "issue_refund":
            if order is None:
                why = "no such order"
            elif reason not in C.REASONS:
                why = "unknown reason"
            elif order[1] not in C.REFUNDABLE:
                why = "not refundable"
            elif any(r[0] == order_id for r in refunds):
                why = "already refunded"
            elif amount is None or amount <= 0:
                why = "not positive"
            elif round(amount, 2) > round(order[2], 2):
                why = "above the total"
            else:
                refunds.append((order_id, round(amount, 2), reason))
        elif tool == "create_ticket":
            why = "no such customer" if customer != who else None if category in C.CATEGORIES else "unknown category"
            if why is None:
                tickets.append((customer, category))
        elif tool == "update_address":
            sent = sorted(o[0] for o in orders or [] if o[1] == "shipped")
            why = "no such customer" if customer != who else f"already shipped: {sent[0]}" if sent else None
            if why is None:
                address = new.strip()
        elif tool == "get_order":
            why = None if order else "no such order"
        elif tool in ("get_customer", "list_orders"):
            why = None if customer == who else "no such customer"
        else:
            why = "no such tool"
        log.append((tool, why))
    return refunds, tickets, address, log


def test_end_states_equal_a_plain_walk(spark):
    rng = random.Random(3)
    pick = rng.choice
    tasks = []
    for i in range(120):
        orders = [(k, pick(["placed", "shipped", "delivered", "delivered"]), pick([10.0, 99.99])) for k in range(rng.randrange(4))]
        calls = [
            (pick(["issue_refund", "issue_refund", "create_ticket", "update_address", "get_order", "get_customer", "list_orders", "other", None]), pick([0, 1, 2, 9, None]), pick([i, i, -1, None]), pick([5.0, 10.0, 99.99, 200.0, 0.0, None]), pick(["late", "damaged", "mood", None]), pick(["billing", "odd", None]), " new ")
            for _ in range(rng.randrange(9))
        ]
        tasks.append((f"t{i}", i, "old", pick([orders, orders, None]), pick([calls, calls, calls, None])))
    schema = f"task_id string, customer_id bigint, address string, orders array<struct<id:bigint,status:string,total:double>>, calls array<{C.CALL}>"
    got = {r.task_id: r for r in C.graded_replays(spark.createDataFrame(tasks, schema)).collect()}
    hashes = {}
    for t in tasks:
        r, (refunds, tickets, address, log) = got[t[0]], walk(t)
        assert [tuple(x) for x in r.refunds] == refunds and [tuple(x) for x in r.tickets] == tickets and r.address == address
        assert [tuple(x) for x in r.log] == log and (r.n_calls_applied, r.n_calls_refused) == (len(log), sum(w is not None for _, w in log))
        hashes.setdefault((address, tuple(sorted(refunds)), tuple(sorted(tickets))), set()).add(r.state_hash)
    assert all(len(h) == 1 for h in hashes.values()) and len({h for s in hashes.values() for h in s}) == len(hashes)
    assert C.graded_replays(spark.createDataFrame([], schema)).count() == 0
