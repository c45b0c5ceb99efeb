"""Independent brute-force references used by the tests (numpy, small inputs only)."""

from __future__ import annotations

import numpy as np


def dbscan_scan_order(X: np.ndarray, eps: float, min_samples: int) -> np.ndarray:
    """Classic DBSCAN visiting points in row order; returns labels (-1 = noise)."""
    n = len(X)
    d2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    nb = [np.nonzero(d2[i] <= eps * eps)[0] for i in range(n)]
    core = np.array([len(v) >= min_samples for v in nb])
    labels = np.full(n, -1)
    cur = 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        labels[i] = cur
        while stack:
            p = stack.pop()
            if not core[p]:
                continue
            for q in nb[p]:
                if labels[q] == -1:
                    labels[q] = cur
                    if core[q]:
                        stack.append(q)
        cur += 1
    return labels


def dbscan_per_group(keys, groups, X, eps, min_samples):
    """Per-group scan-order DBSCAN, rows ordered by key inside each group.

    Returns ``{key: (local_label, global_label)}`` with global ids running over
    groups ascending.
    """
    keys = np.asarray(keys)
    groups = np.asarray(groups)
    out = {}
    offset = 0
    for g in sorted(set(groups.tolist())):
        idx = np.nonzero(groups == g)[0]
        idx = idx[np.argsort(keys[idx], kind="stable")]
        lab = dbscan_scan_order(X[idx], eps, min_samples)
        k = int(lab.max()) + 1 if len(lab) else 0
        for i, l in zip(idx, lab):
            out[keys[i].item()] = (int(l), int(l) + offset if l >= 0 else -1)
        offset += k
    return out
