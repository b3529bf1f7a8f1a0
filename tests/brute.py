"""One-by-one application of events in plain Python, to check the set-based results against."""

from decimal import ROUND_HALF_UP, Decimal

CENT = Decimal("0.01")


def amount_of(event):
    try:
        value = Decimal(event["total_amount"].replace(" USD", "").strip())
    except ArithmeticError:
        return None
    return value if value.is_finite() else None


def ratio(n, d):
    return (Decimal(n) / Decimal(d)).quantize(CENT, ROUND_HALF_UP) if d else Decimal("0.00")


def value_of(revenue, visits, weeks, positive_only=False):
    rpv = ratio(revenue, visits) if revenue > 0 or not positive_only else Decimal("0.00")
    vpw = ratio(visits, weeks)
    return rpv, vpw, (520 * rpv * vpw).quantize(CENT, ROUND_HALF_UP)


def week_number(event):
    from datetime import datetime

    try:
        return int(datetime.strptime(event["event_time"].split("T")[0], "%Y-%m-%d").strftime("%U"))
    except ValueError:
        return None


def run_fold(events):
    """(state {(type, key): event}, outcome per event) of events given in order."""
    state, outcome = {}, []
    for e in events:
        slot = (e["type"], e["key"])
        if e["type"] not in ("CUSTOMER", "SITE_VISIT", "IMAGE", "ORDER"):
            outcome.append("IGNORED_TYPE")
        elif e["type"] == "ORDER" and amount_of(e) is None:
            outcome.append("INVALID_AMOUNT")
        elif e["type"] in ("SITE_VISIT", "IMAGE"):
            outcome.append("DUPLICATE_KEY" if slot in state else "APPLIED")
            state.setdefault(slot, e)
        elif e["verb"] not in ("NEW", "UPDATE"):
            outcome.append("IGNORED_VERB")
        elif (e["verb"] == "NEW") == (slot in state):
            outcome.append("DUPLICATE_NEW" if e["verb"] == "NEW" else "UPDATE_WITHOUT_KEY")
        else:
            outcome.append("APPLIED")
            state[slot] = e
    return state, outcome


def fold_values(state):
    """customer -> (revenue per visit, visits per week, ltv)."""
    out = {}
    for kind, customer in state:
        if kind == "CUSTOMER":
            visits = [e for (t, _), e in state.items() if t == "SITE_VISIT" and e["customer_id"] == customer]
            sales = [e for (t, _), e in state.items() if t == "ORDER" and e["customer_id"] == customer]
            revenue = sum((amount_of(e) for e in sales), Decimal(0))
            out[customer] = value_of(revenue, len(visits), len({week_number(e) for e in visits}))
    return out


def touch_values(events):
    """customer -> (visits, weeks, ltv) when every accepted event is a visit."""
    people = {}

    def visit(owner, e):
        person = people.setdefault(owner, {"weeks": [], "seen": set(), "orders": {}})
        person["weeks"].append(week_number(e))
        return person

    for e in events:
        kind, verb = e["type"], e["verb"]
        owner = e["key"] if kind == "CUSTOMER" else e.get("customer_id")
        known = people.get(owner)
        mark = (kind, e["key"])
        if kind == "CUSTOMER" and (verb == "NEW" or (verb == "UPDATE" and known)):
            visit(owner, e)
        elif kind == "SITE_VISIT" or (kind == "IMAGE" and known):
            if not known or mark not in known["seen"]:
                visit(owner, e)["seen"].add(mark)
        elif kind == "ORDER" and known and amount_of(e) is not None and verb in ("NEW", "UPDATE"):
            if (verb == "UPDATE") == (e["key"] in known["orders"]):
                visit(owner, e)["orders"][e["key"]] = amount_of(e)
    return {
        owner: (
            len(p["weeks"]),
            len(set(p["weeks"])),
            value_of(sum(p["orders"].values(), Decimal(0)), len(p["weeks"]), len(set(p["weeks"])), True)[2],
        )
        for owner, p in people.items()
    }
