"""Plain row-by-row models of the semantics, for comparison with the Spark operators."""

import math


def clipped(x, lo=1e-4):
    return min(max(x, lo), 1 - lo)


def decide(p, q, threshold):
    if p is None or q is None or math.isnan(p) or math.isnan(q):
        return "PASS", 0.0
    gap = clipped(p) - clipped(q)
    if gap >= 0 and gap > threshold:
        return "YES", gap
    return ("NO", -gap) if -gap > threshold else ("PASS", 0.0)


def kelly(side, p, q):
    if side == "PASS":
        return 0.0
    p, q = clipped(p), clipped(q)
    return max(0.0, (p - q) / (1 - q) if side == "YES" else (q - p) / q)


def cents(x):
    return math.floor(x * 100 + 0.5) / 100


def backtest(rows, threshold=0.02, start=5000.0, safety=0.3, cap=0.025, fee=0.02):
    """rows: (date, p, q, outcome) in order -> metrics and equity."""
    bank, curve, edges, wins, returns = start, [], [], 0, []
    for date, p, q, outcome in rows:
        side, edge = decide(p, q, threshold)
        used = min(kelly(side, p, q) * safety, cap)
        change = 0.0
        if used > 0:
            price = clipped(q)
            odds = (1 - price) / price if side == "YES" else price / (1 - price)
            hit = (outcome == 1) == (side == "YES")
            stake = used * start
            change = (stake * odds if hit else -stake) - fee * stake
            edges.append(edge)
            wins += hit
        bank += change
        curve.append((date, cents(bank)))
        returns.append(change / start)
    peak, fall = -math.inf, 0.0
    for _, value in curve:
        peak = max(peak, value)
        fall = max(fall, (peak - value) / peak)
    mean = sum(returns) / len(returns)
    std = math.sqrt(sum((x - mean) ** 2 for x in returns) / len(returns))
    growth = bank / start
    return {
        "n_trades": len(edges),
        "avg_edge": sum(edges) / len(edges) if edges else 0.0,
        "hit_rate": wins / len(edges) if edges else 0.0,
        "monthly_roi": growth ** (30.0 / len(rows)) - 1 if growth >= 0 else None,
        "total_return": growth - 1,
        "max_drawdown": fall,
        "sharpe": mean / std * math.sqrt(252) if std > 1e-12 else 0.0,
        "final_bankroll": cents(bank),
    }, curve


def replay(quotes, min_spread=0.0005):
    """quotes: (market, seq, venue, bid, ask) -> {(market, seq): (buy, sell, ask, bid)}."""
    books, found = {}, {}
    for market, seq, venue, bid, ask in sorted(quotes, key=lambda x: (x[1], x[2])):
        if not bid or not ask or bid <= 0 or ask <= 0:
            continue
        book = books.setdefault(market, {})
        book[venue] = (bid, ask)
        buy = min(book, key=lambda v: (book[v][1], v))
        sell = min(book, key=lambda v: (-book[v][0], v))
        low, high = book[buy][1], book[sell][0]
        if buy != sell and high > low and (high - low) / low >= min_spread:
            found[(market, seq)] = (buy, sell, low, high)
    return found


def lower_rank(values, p):
    values = sorted(values)
    return values[int(p / 100.0 * (len(values) - 1))] if values else 0.0
