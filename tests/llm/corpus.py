"""Small corpora with awkward rows, and plain versions of what the operators compute."""

import hashlib
import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns whose names the operators use themselves.
CLASHING = "id string, n string, state string, kind string, spans string, score string, node string, key string, part string, label string, doc string, order string, text_key string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(random_, count, size=400):
    return [f"{random_.choice('abcdefgh')}{random_.randrange(size)}" for _ in range(count)]


def texts():
    """Copies, near copies, shared passages, short, empty and long texts, odd white space and letters."""
    r = random.Random(3)
    base = [" ".join(words(r, r.choice([3, 4, 5, 6, 8, 12, 30, 90, 200]))) for _ in range(30)]
    out = list(base)
    for text in base[:12]:
        out += [text, text.upper()]
        for share in (0.01, 0.03, 0.1):
            w = text.split()
            for k in range(len(w)):
                if r.random() < share:
                    w[k] = "zz" + str(r.randrange(99))
            out.append(" ".join(w))
    passage = " ".join(words(r, 60))
    out += [f"{' '.join(words(r, 40))} {passage} {' '.join(words(r, 50))}" for _ in range(8)]
    out += [" ".join(words(r, 6000)), "", " ", "x", "Ünïcödé Straße ÀÉ " * 9, "same same same same same same", "a\tb\nc\x0bd\x0ce\rf", "\x00 \x1f a", "ab" * 300]
    out += [None, None, ""]
    return out


def docs(spark, values=None, clash=True):
    values = texts() if values is None else values
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(values)]
    schema = DOCS
    if clash:
        extra = len(CLASHING.split(", "))
        rows = [(*row, *["?"] * extra) for row in rows]
        schema += ", " + CLASHING
    return spark.createDataFrame(rows, schema).repartition(5)


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def components(values):
    """Least reachable id per row (values: text by id), by comparing all pairs."""
    sets = {k: shingles(t) for k, t in values.items()}
    head = {k: k for k in values}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    ids = sorted(values)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                head[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in ids}
