"""Sequential replay of a change log in plain Python: the meaning the jobs are tested against."""


def replay(table, log, names):
    """``table``: key -> row dict. ``log``: (op, old key, new key, set columns). Returns (table, outcomes)."""
    rows = {k: dict(v) for k, v in table.items()}
    outcomes = []
    for op, old, new, cols in log:
        status = None
        if op == "I":
            rows[new] = {n: cols.get(n) for n in names}
        elif op == "U":
            if old in rows:
                rows[old].update(cols)
        elif op == "D":
            rows.pop(old, None)
        elif op == "K":
            if old not in rows:
                status = "missing"
            elif new in rows:
                status = "collision"
            else:
                rows[new] = rows.pop(old)
                rows[new].update(cols)
                status = "moved"
        outcomes.append(status)
    return rows, outcomes


def random_log(rng, n, n_keys, ops="IUKD"):
    log = []
    for _ in range(n):
        op = rng.choice(ops)
        key = rng.randrange(n_keys)
        cols = {}
        for name in ("c2", "c3"):
            if op in "IUK" and rng.random() < 0.6:
                cols[name] = rng.choice([None, f"{name}{rng.randrange(100)}"])
        new = key
        if op == "K":
            new = rng.choice([k for k in range(n_keys) if k != key])
        log.append((op, key, new, cols))
    return log
