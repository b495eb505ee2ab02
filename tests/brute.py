"""Plain-Python brute force of the scorer contract (tests only): LCS by
dynamic programming, windows enumerated one by one."""

from __future__ import annotations


def lcs(a: str, b: str) -> int:
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b):
            cur.append(prev[j] + 1 if ca == cb else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def ratio(a: str, b: str) -> float:
    s = len(a) + len(b)
    return 100.0 if s == 0 else 200.0 * lcs(a, b) / s


def _nd(d, n):
    return 100.0 if n == 0 else 100.0 - 100.0 * d / n


def token_sort(a, b):
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a, b):
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    inter, da, db = ta & tb, ta - tb, tb - ta
    if inter and (not da or not db):
        return 100.0
    sa, sb = " ".join(sorted(da)), " ".join(sorted(db))
    s = len(" ".join(sorted(inter)))
    e = 1 if s else 0
    d = len(sa) + len(sb) - 2 * lcs(sa, sb)
    r1 = _nd(d, (s + e + len(sa)) + (s + e + len(sb)))
    if s == 0:
        return r1
    return max(r1, _nd(e + len(sa), s + (s + e + len(sa))), _nd(e + len(sb), s + (s + e + len(sb))))


def _partial_dir(x, y):
    if not x:
        return 100.0 if not y else 0.0
    best = 0.0
    lx, ly = len(x), len(y)
    for j in range(1 - lx, ly):
        st, en = max(j, 0), min(ly, j + lx)
        w = y[st:en]
        best = max(best, 200.0 * lcs(x, w) / (lx + len(w)))
    return best


def partial(a, b):
    if len(a) < len(b):
        return _partial_dir(a, b)
    if len(a) > len(b):
        return _partial_dir(b, a)
    return max(_partial_dir(a, b), _partial_dir(b, a))


def partial_token(a, b):
    ta, tb = a.split(), b.split()
    if set(ta) & set(tb):
        return 100.0
    p1 = partial(" ".join(sorted(ta)), " ".join(sorted(tb)))
    p2 = partial(" ".join(sorted(set(ta))), " ".join(sorted(set(tb))))
    return max(p1, p2)


def weighted(a, b):
    la, lb = len(a), len(b)
    if not la or not lb:
        return 0.0
    q = max(la, lb) / min(la, lb)
    r = ratio(a, b)
    if q < 1.5:
        return max(r, 0.95 * max(token_sort(a, b), token_set(a, b)))
    p = 0.9 if q <= 8 else 0.6
    return max(r, p * partial(a, b), 0.95 * p * partial_token(a, b))


SCORERS = dict(ratio=ratio, token_sort=token_sort, token_set=token_set,
               partial=partial, partial_token=partial_token, weighted=weighted)


def normalize_text(t: str) -> str:
    import re
    t = t.lower().replace("&", " and ").replace("-", " ").replace("/", " ")
    t = t.replace("®", "").replace("™", "")
    return re.sub(r"\s+", " ", t).strip()
