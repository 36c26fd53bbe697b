"""Plain sequential oracles for replay, features and strict runs, written from the stated semantics."""

import math
from bisect import insort

NS = 1_000_000_000


def covered(intervals, a, b):
    return sum(max(0, min(b, e) - max(a, s)) for s, e in intervals)


def inside(intervals, x):
    return any(s <= x < e for s, e in intervals)


class Quote:
    def __init__(self):
        self.bid = self.ask = self.bs = self.as_ = self.last = self.origin = self.change = None
        self.valid = self.spread = self.bad = False

    def apply(self, q, lot):
        ts, _, bid, ask, bs, as_, codes, _ = q
        self.last = ts
        ok = all(isinstance(x, (int, float)) and math.isfinite(x) and x > 0 for x in (bid, ask)) and ask >= bid and not set(codes or []) & {-1, 2, 15, 19, 20, 32, 34, 80, 83, 84} and 24 not in (codes or [])
        if not ok:
            last = ts
            self.__init__()
            self.last, self.bad = last, True
            return
        mid = bid / 2 + ask / 2
        if not self.valid:
            self.origin, self.change = ts, None
        elif mid != self.bid / 2 + self.ask / 2:
            self.change = ts
        self.bid, self.ask, self.valid = bid, ask, True
        self.spread = not (85 in (codes or []) and bid != ask)
        self.bs = bs * lot if bs and bs > 0 else None
        self.as_ = as_ * lot if as_ and as_ > 0 else None


def keep_bad(q):
    """invalid_seen survives a valid quote."""
    return q.bad


def replay(quotes, trades, ctx):
    """Rows of dicts, one per second; ``trades`` come as (ts, seq, kind, price, shares)."""
    start, end, lot = ctx["start"], ctx["end"], ctx.get("lot", 1.0)
    qo, to, qg, tg = ctx["qo"], ctx["to"], ctx.get("qg", []), ctx.get("tg", [])
    qb = sorted(ctx.get("qb", []) + [s for s, _ in qg])
    tb = sorted(ctx.get("tb", []) + [s for s, _ in tg])
    halts = ctx.get("halts", [])
    st, last_trade, qc, tc, qbr, tbr, was = Quote(), None, 0, 0, False, False, False
    out = []
    for left in range(start, end, NS):
        right = left + NS
        h = [x for x in halts if x[0] < right and x[1] > left]
        if h and not was:
            st, last_trade, qc, tc, qbr, tbr = Quote(), None, qc + 1, tc + 1, True, True
        events = [(x, 0, None) for x in qb if left <= x < right] + [(q[0], 1, q) for q in quotes if left <= q[0] < right]
        events.sort(key=lambda e: (e[0], e[1], e[2][1] if e[2] else -1))
        acc = dict(b=0.0, a=0.0, s=0.0, bs=0.0, as_=0.0, pn=0, sn=0, bn=0, an=0)
        at = left
        for ts, kind, q in [*events, (right, 2, None)]:
            ns = covered(qo, at, ts) - covered(qg, at, ts)
            if not h and ns > 0 and st.valid:
                sec = ns / NS
                acc["b"] += st.bid * sec
                acc["a"] += st.ask * sec
                acc["pn"] += ns
                if st.spread:
                    acc["s"] += 1e4 * (st.ask - st.bid) / (st.bid / 2 + st.ask / 2) * sec
                    acc["sn"] += ns
                if st.bs:
                    acc["bs"] += st.bs * sec
                    acc["bn"] += ns
                if st.as_:
                    acc["as_"] += st.as_ * sec
                    acc["an"] += ns
            at = ts
            if kind == 0:
                st, qc, qbr = Quote(), qc + 1, True
            elif kind == 1 and not h and not inside(qg, ts):
                bad = st.bad
                st.apply(q, lot)
                st.bad = st.bad or bad
                qbr = False
        n, shares, dollars, unsure = 0, 0.0, 0.0, False
        events = [(x, 0, None) for x in tb if left <= x < right] + [(x[0], 1, x) for x in trades if left <= x[0] < right]
        events.sort(key=lambda e: (e[0], e[1], e[2][1] if e[2] else -1))
        for ts, kind, tr in events:
            if kind == 0:
                last_trade, tc, tbr = None, tc + 1, True
            elif not h and not inside(tg, ts):
                if tr[2] == "uncertain":
                    unsure, last_trade = True, None
                elif tr[2] == "eligible":
                    n, shares, dollars, last_trade, tbr = n + 1, shares + tr[4], dollars + tr[3] * tr[4], ts, False
        tobs = max(0, covered(to, left, right) - covered(tg, left, right))
        active = 0 if h or unsure else tobs
        out.append({
            "end": right, "bid_twap": acc["b"] / (acc["pn"] / NS) if acc["pn"] else None, "pn": acc["pn"], "spread": acc["s"] if acc["sn"] else None, "sn": acc["sn"],
            "bid_size": acc["bs"] if acc["bn"] else None, "ask_size": acc["as_"] if acc["an"] else None, "bid_end": st.bid if st.valid and not h else None,
            "n": n if active else None, "shares": shares if active else None, "dollars": dollars if active else None, "active": active,
            "trade_age": (right - last_trade) / NS if last_trade is not None and not h else None, "quote_age": (right - st.last) / NS if st.last is not None and not h else None,
            "mid_age": (right - st.change) / NS if st.valid and st.change is not None and not h else None, "origin": st.origin if st.valid and not h else None,
            "qc": qc, "tc": tc, "qbr": qbr, "tbr": tbr, "halt": bool(h), "bad": st.bad,
        })
        was = bool(h)
    return out


def ew(rows, half_life, startup, spread_floor=0.9, other_floor=0.8):
    """RMS, participation, spread and trade rate with masks, by the recurrence."""
    lam = 2.0 ** (-1.0 / half_life)
    z = lambda: dict(w=0.0, rp=0.0, u1=0.0, u2=0.0, p=0.0, sn=0.0, su=0.0, tn=0.0, tu=0.0)
    s, ring, n, ever = z(), [], 0, False
    out = []
    for r in rows:
        if r["halt_active"]:
            s, ring, n, ever = z(), [], 0, False
        else:
            n += 1
            ok = r["price_end_reason_mask"] == 0
            ring = (ring + [((r["bid_end_usd"] / 2 + r["ask_end_usd"] / 2) if ok else None, r["quote_continuity_id"])])[-6:]
            ret = None
            if len(ring) == 6 and ring[0][0] is not None and ring[5][0] is not None and ring[0][1] == ring[5][1]:
                ret = 1e4 * math.log(ring[5][0] / ring[0][0])
            for k in s:
                s[k] *= lam
            s["p"] += 1
            s["rp"] += len(ring) == 6
            if ret is not None:
                s["w"], s["u1"], s["u2"] = s["w"] + 1, s["u1"] + abs(ret), s["u2"] + ret * ret
                ever = ever or ret != 0
            s["sn"], s["su"] = s["sn"] + (r["spread_integral_bps_seconds"] or 0), s["su"] + r["spread_valid_duration_ns"] / NS
            s["tn"], s["tu"] = s["tn"] + (r["trade_count_1s"] or 0), s["tu"] + r["activity_valid_duration_ns"] / NS

        def mask(side, usable, possible, floor):
            m = {0: 2, 1: 0, 2: 1}[r[f"{side}_source_status"]] | (4 if r["halt_active"] else 0) | (8 if n < startup else 0)
            return m | (32 if usable == 0 else 16 if n >= startup and usable < floor * possible else 0)

        mr, ms, mt = mask("quote", s["w"], s["rp"], other_floor), mask("quote", s["su"], s["p"], spread_floor), mask("trade", s["tu"], s["p"], other_floor)
        mp = mr | (1024 if mr == 0 and not ever else 0)
        out.append({
            "rms": (math.sqrt(s["u2"] / s["w"]) if mr == 0 else None, mr), "participation": (min(1, s["u1"] ** 2 / s["w"] / s["u2"]) if mp == 0 else None, mp),
            "spread": (s["sn"] / s["su"] if ms == 0 else None, ms), "rate": (s["tn"] / s["tu"] if mt == 0 else None, mt),
        })
    return out


def age_p90(rows, age, window, floor=0.8):
    side = "trade" if age == "trade" else "quote"
    slots, out = [], []
    for r in rows:
        if r["halt_active"]:
            slots = []
        else:
            if r[f"{side}_continuity_break_in_second"]:
                slots = []
            if r[f"{side}_observed_duration_ns"] == NS and not r[f"{side}_interior_break"]:
                slots = (slots + [r[f"{age}_age_seconds"] if r[f"{age}_age_reason_mask"] == 0 else None])[-window:]
        known = []
        for x in slots:
            if x is not None:
                insort(known, x)
        m = {0: 2, 1: 0, 2: 1}[r[f"{side}_source_status"]] | (4 if r["halt_active"] else 0) | (8 if len(slots) < window else 0)
        m |= 32 if not known else 16 if len(slots) >= window and len(known) < math.ceil(floor * window) else 0
        p = 0.9 * (len(known) - 1)
        lo, hi = int(math.floor(p)), int(math.ceil(p))
        out.append((known[lo] + (p - lo) * (known[hi] - known[lo]) if m == 0 else None, m, len(known), len(slots)))
    return out


def strict_runs(rows, identity, sources):
    """Runs over rows sorted by member and time, by one pass."""
    out, cur, prev, pre, ordinal = [], None, None, "member_boundary", 0

    def close(reason):
        nonlocal cur, pre, ordinal
        if cur is not None:
            out.append({**cur, "closure": reason, "ordinal": ordinal})
            ordinal += 1
        cur, pre = None, reason

    for r in rows:
        member = (r["session_date"], r["symbol"])
        if prev is not None:
            if member != (prev["session_date"], prev["symbol"]):
                close("member_boundary")
            elif r["selection_segment_id"] != prev["selection_segment_id"]:
                close("selection_boundary")
            elif any(r[f"{s}_continuity_id"] != prev[f"{s}_continuity_id"] or r[f"{s}_continuity_break_in_second"] for s in sources):
                close("source_continuity")
        if r.get("before"):
            close(r["before"])
        if r["halt_active"]:
            close("halt")
        elif r["status"] == "matching":
            if cur is None:
                cur = {"member": member, "first": r["interval_end_ns"], "count": 0, "preceding": pre}
            cur["last"], cur["count"] = r["interval_end_ns"], cur["count"] + 1
        else:
            close(r["status"])
        if r.get("after"):
            close(r["after"])
        prev = r
    close("selection_boundary")
    return out
