"""Plain versions of the operators, as slow and as simple as they can be."""

import html
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from tradeloom.llm import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


def article(page):
    """The article of a page of the shared tables, whose only inline element is b."""
    body = page[page.index("<article>") + 9:].split("</article>")[0]
    return " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", body))).split())


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]
    found = [(m.start(), i, kind, m.end()) for i, (kind, pattern, valid) in enumerate(kinds)
             for m in re.finditer(pattern, text or "") if valid(m[0])]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def pieces(text, reach=6, long=20):
    """(normalised text, start, end, words, whether it may go by itself) of the lines, sentences and parts of long sentences of a text."""
    found = []
    for line in re.finditer("[^\n]+", text):
        words = [(line.start() + m.start(), line.start() + m.end(), m[0]) for m in WORD.finditer(line[0])]
        sentences = [[]]
        for word in words:
            if sentences[-1] and sentences[-1][-1][2][-1] in ".!?":
                sentences.append([])
            sentences[-1].append(word)
        for sentence in filter(None, sentences):
            plain = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for _, _, w in sentence]
            hashes = pd.util.hash_array(np.array([w.encode() for w in plain], dtype=object), categorize=False)
            order = substring_dedup._scrambled(hashes ^ substring_dedup._FACTORS[2]).tolist()
            parts = [[]]
            for i, word in enumerate(sentence):
                parts[-1].append((word, plain[i]))
                left, right = order[max(0, i - reach):i], order[i + 1:i + 1 + reach]
                if len(sentence) > long and all(order[i] < x for x in left) and all(order[i] <= x for x in right) and i + 1 < len(sentence):
                    parts.append([])
            for part in parts:
                alone = len(parts) == 1 and (len(part) >= 10 or (len(sentences) == 1 and len(part) >= 5))
                found.append((" ".join(w for _, w in part), part[0][0][0], part[-1][0][1], len(part), alone))
    return found


def removals(rows):
    """(row number, key, start, end, first key, first start) of the runs that go."""
    first, cut = {}, []
    for number, (key, text) in enumerate(rows):
        cut.append(pieces(text or ""))
        for piece in cut[-1]:
            place = (key is None, key, number, piece[1])
            first[piece[0]] = min(first.get(piece[0], place), place)
    found = []
    for number, (key, _) in enumerate(rows):
        run = []
        for piece in [*cut[number], None]:
            if piece and first[piece[0]][2:] != (number, piece[1]):
                run.append(piece)
                continue
            for part in [run] if sum(p[3] for p in run) >= 16 else [[p] for p in run if p[4]]:
                _, origin, _, at = first[part[0][0]]
                found.append((number, key, part[0][1], part[-1][2], origin, at))
            run = []
    return found


def repeated_runs(rows, words=50):
    """(row number, first word, last word) of the longest stretches of which all windows of so many words are in an earlier row."""
    seen, found = set(), []
    for number, (_, text) in enumerate(rows):
        plain = WORD.findall((text or "").lower())
        windows = [hash(tuple(plain[i:i + words])) for i in range(len(plain) - words + 1)]
        start = None
        for i, w in enumerate([*windows, None]):
            if w in seen and start is None:
                start = i
            elif w not in seen and start is not None:
                found.append((number, start, i + words - 2))
                start = None
        seen.update(windows)
    return found


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def near_components(rows):
    sets = {key: shingles(text) for key, text in rows}
    component = {key: key for key in sets}

    def root(key):
        while component[key] != key:
            key = component[key]
        return key

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                component[high] = low
    return {key: (len(sets[key]), root(key)) for key in keys}


def hard_negatives(rows, every, positives=5, negatives=10):
    """Every anchor with every other row."""
    rows = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows]
    found = []
    for anchor, v, label in rows:
        if anchor % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i, other) for i, w, other in rows if i != anchor)
        for score, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and 30 * -score <= 100 * -s[0] <= 90 * -score][:negatives]
            found += [(anchor, positive, rank, i, -score, -s) for rank, (s, i, _) in enumerate(fit, 1)]
    return sorted(found)


def one_edit(a, b):
    """Whether one inserted, deleted or replaced code point makes a into b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling_variants(rows, min_length=6, min_times=5):
    """{word: (form, root, n, n_near, form_n)}."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    words = sorted(w for w in n if len(w) >= min_length and n[w] >= min_times)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(near[w], key=lambda v: (-n[v], v)) for w in words if near[w]}
    form = {w: v for w, v in best.items() if n[v] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in words}
