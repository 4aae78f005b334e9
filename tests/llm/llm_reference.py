"""Plain Python versions of what the operators compute."""

import re

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FOLD = str.maketrans(UPPER, UPPER.lower())
PII_KINDS = ("email", "ip", "card", "phone")


def words(text, fold=True):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(FOLD) if fold else text)


def shingles(text):
    w = words(text)
    if len(w) >= 5:
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    return frozenset([tuple(w)]) if w else frozenset()


def components(docs):
    """{id: least id reachable}, all pairs compared."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            both = len(a & b)
            if a and b and 100 * both >= 75 * (len(a) + len(b) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def luhn(digits):
    total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1]))
    return total % 10 == 0


def pii_base(text):
    found = [("email", *m.span()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return found


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def quality(text):
    w, t = words(text, fold=False), text or ""
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t),
            len(lines) - len(set(lines)), len(covered))
