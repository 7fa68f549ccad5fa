"""The operators restated for one small array each, for checking by brute force."""

import math


def firings(n, size, slide):
    """{k: indices} of a sliding count window over n samples."""
    return {k: list(range(max(0, k * slide - size), k * slide)) for k in range(1, n // slide + 1)}


def is_first_max(xs, m, width):
    low, high = max(0, m - width), min(len(xs), m + width + 1)
    return m == min(i for i in range(low, high) if xs[i] == max(xs[low:high]))


def hold(xs, decay):
    out, level = [], xs[0]
    for x in xs:
        level = max(x, decay * level + (1 - decay) * x)
        out.append(level)
    return out


def passes(xs, m, width, threshold, relative=False, level=None):
    if level is not None and xs[m] < level:
        return False
    if not relative:
        return xs[m] > threshold
    near = xs[max(0, m - 3 * width) : min(len(xs), m + width)]
    return bool(near) and xs[m] > sum(near) / len(near) + threshold


def peaks(xs, width, threshold, decay=0.0, relative=False):
    levels = hold(xs, decay) if xs else []
    return [
        m
        for m in range(len(xs))
        if is_first_max(xs, m, width)
        and passes(xs, m, width, threshold, relative, levels[m] if decay else None)
    ]


def top_peaks(xs, n, width):
    found = [m for m in range(len(xs)) if is_first_max(xs, m, width)]
    return sorted(found, key=lambda m: (-xs[m], m))[:n]


def slope(xs, hop, n):
    def fit(s):
        ts = [i * hop for i in range(n)]
        ys = xs[s : s + n]
        mt, my = sum(ts) / n, sum(ys) / n
        return sum((t - mt) * (y - my) for t, y in zip(ts, ys)) / sum((t - mt) ** 2 for t in ts)

    if len(xs) < n:
        return [None] * len(xs)
    return [fit(min(max(j - n // 2, 0), len(xs) - n)) for j in range(len(xs))]


def z_scores(xs):
    mean = sum(xs) / len(xs)
    sd = math.sqrt(sum((x - mean) ** 2 for x in xs) / len(xs))
    return [(x - mean) / (sd or 1) for x in xs]


def energy(part):
    inner = [part[j + 1] ** 2 - part[j] * part[j + 2] for j in range(len(part) - 2)]
    return inner + [0.0] * min(2, len(part))


def anomalies(xs, size, slide, width, threshold=0.75, fs=360.0, te=0.018, rr=0.4):
    """(k, seg, start, len, stamped index, slice) of every abnormal beat."""
    out = []
    for k, idx in firings(len(xs), size, slide).items():
        win = [xs[i] for i in idx]
        found = peaks(win, width, threshold)
        for i, (a, b) in enumerate(zip(found, found[1:])):
            part = win[a : b + 1]
            if math.fsum(energy(part)) / len(part) < te or len(part) / fs < rr:
                out.append((k, i + 1, a, len(part), idx[i], part))
    return out
