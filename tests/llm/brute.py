"""Plain and slow versions of the operators, for small inputs."""

import hashlib
import itertools
import re
from collections import Counter

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rules(text):
    w = words(text)
    n = len(w)
    seen = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    hit = [False] * n
    for i in range(n - 2):
        if seen[tuple(w[i : i + 3])] > 1:
            hit[i : i + 3] = [True] * 3
    lines, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in lines
            lines.add(line)
    repeat = sum(hit)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), again, repeat, n < 50 or 100 * repeat > 50 * n


def longest_repeat(w):
    best = 0
    for i, j in itertools.combinations(range(len(w)), 2):
        size = 0
        while j + size < len(w) and w[i + size] == w[j + size]:
            size += 1
        best = max(best, size)
    return best


def shingles(text, width=5):
    w = (text or "").translate(LOWER).encode().split()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def classes(texts, threshold=0.8):
    """Least id of each text's class and its number of different linked texts."""
    same = {i: tuple((t or "").translate(LOWER).encode().split()) for i, t in texts.items()}
    sets = {i: shingles(t) for i, t in texts.items()}
    least = {i: i for i in texts}
    links = {i: set() for i in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        shared = len(sets[a] & sets[b])
        if shared and shared / len(sets[a] | sets[b]) >= threshold:
            old, new = max(least[a], least[b]), min(least[a], least[b])
            least = {i: new if x == old else x for i, x in least.items()}
            if same[a] != same[b]:
                links[a].add(same[b])
                links[b].add(same[a])
    return {i: (least[i], len(links[i])) for i in texts}


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items):
    w = item_words(text)
    hit, found = [False] * len(w), set()
    for name, body in items:
        v = item_words(body)
        size = min(13, len(v))
        for p in range(len(v) - size + 1 if v else 0):
            for j in range(len(w) - size + 1):
                if w[j : j + size] == v[p : p + size]:
                    found.add(name)
                    hit[j : j + size] = [True] * size
    return len(w), sum(hit), sorted(found)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii(text):
    out, text = [], text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def secrets(text):
    out, text = [], text or ""
    name = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"""({name})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 32:
            out.append((m.start(), 2, "hex", m.end()))
    return sorted(out)


def digest(spans):
    return hashlib.sha256(",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans).encode()).hexdigest()
