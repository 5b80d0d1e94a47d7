"""Plain versions of operators, to compare with."""

import re
import string

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def components_by_hand(rows):
    """The smallest id that each can reach over pairs with a similarity of 0.75 or more."""
    rows = sorted(rows)
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) and 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {doc_id: rows[find(i)][0] for i, (doc_id, _) in enumerate(rows)}


def leaky_ids(rows, items, size=10):
    """Ids of texts that hold a window of an item."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = {tuple(w[i : i + size]) for w in map(words, items) if w for i in range(max(len(w) - size, 0) + 1)}
    sizes = {len(w) for w in windows}
    return {
        i for i, t in rows for w in [words(t)] if any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))
    }
