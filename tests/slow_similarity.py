"""Pure Python scorers: the slow versions that the Column functions are compared with."""


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence (bit-parallel, exact)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    if total == 0:
        return 100.0
    return _norm_sim(total - 2 * lcs_length(a, b), total)


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def _norm_sim(dist: int, lensum: int) -> float:
    return 100.0 * (1 - dist / lensum) if lensum else 100.0


def token_set_ratio(a: str, b: str) -> float:
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    inter = ta & tb
    dab, dba = ta - tb, tb - ta
    if inter and (not dab or not dba):
        return 100.0
    s_ab, s_ba = " ".join(sorted(dab)), " ".join(sorted(dba))
    sect_len = len(" ".join(sorted(inter)))
    sep = 1 if sect_len else 0
    ab_len = sect_len + sep + len(s_ab)
    ba_len = sect_len + sep + len(s_ba)
    # ratio between "sect + diff_ab" and "sect + diff_ba": only the diffs differ
    indel = len(s_ab) + len(s_ba) - 2 * lcs_length(s_ab, s_ba)
    result = _norm_sim(indel, ab_len + ba_len)
    if not sect_len:
        return result
    r_ab = _norm_sim(sep + len(s_ab), sect_len + ab_len)
    r_ba = _norm_sim(sep + len(s_ba), sect_len + ba_len)
    return max(result, r_ab, r_ba)
