"""Plain Python versions of what the operators of the corpus package return."""

import collections
import re

BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        twice = int(c) * (1 + i % 2)
        total += twice - 9 * (twice > 9)
    return total % 10 == 0


def base_pii(text):
    text, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


SECRETS = {
    "assign": r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}


def base_secrets(text):
    out = []
    for i, (kind, pattern) in enumerate(SECRETS.items()):
        for m in re.finditer(pattern, text or ""):
            if len(m.group(2)) >= 6 if kind == "assign" else len(m.group()) >= {"access": 20, "hex": 24}[kind]:
                out.append((m.start(), i, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def line_dedup(docs, least=10):
    """docs: id -> text. id -> (lines, dropped, text)."""
    key = lambda line: line.strip(BLANK).translate(LOWER)
    holders = collections.defaultdict(set)
    for i, text in docs.items():
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(i)
    first = {k: min(v) for k, v in holders.items() if len(v) > 1}
    out = {}
    for i, text in docs.items():
        lines = (text or "").split("\n")
        kept = [line for line in lines if first.get(key(line), i) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def grams(text, width=5):
    own = words(text)
    return {tuple(own)} if 0 < len(own) < width else {tuple(own[i : i + width]) for i in range(len(own) - width + 1)}


def near(docs, threshold=0.8):
    """docs: id -> text. id -> (class, links)."""
    sets = {i: grams(t) for i, t in docs.items()}
    linked = lambda a, b: sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9
    return _linked(sorted(docs), linked)


def _linked(ids, linked):
    links = {i: [j for j in ids if j != i and linked(i, j)] for i in ids}
    root = {}
    for i in ids:
        if i not in root:
            queue = [i]
            while queue:
                j = queue.pop()
                if j not in root:
                    root[j] = i
                    queue += links[j]
    return {i: (root[i], len(links[i])) for i in ids}


def near_vectors(rows, threshold=0.93):
    """rows: (id, vector, label). id -> (component, links)."""
    import math

    good = {}
    for i, v, label in rows:
        if v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            norm = math.sqrt(sum(x * x for x in v))
            good[i] = ([x / norm for x in v], label)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    linked = lambda a, b: a in good and b in good and good[a][1] == good[b][1] and dot(good[a][0], good[b][0]) >= threshold
    return _linked(sorted(r[0] for r in rows), linked)


def rules(text):
    own = words(text)
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    times = collections.Counter(windows)
    covered = {k for i, w in enumerate(windows) if times[w] > 1 for k in range(i, i + 5)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)
