"""Personal data: patterns propose spans, check sums confirm them, context words adjust the score.

All of it is Spark's own columns. Positions come from the lengths of the pieces between matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lengths of IBANs by country. A match of a known country has just its length, so that the search goes on right behind it.
IBAN_LENGTH = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HU": 28, "IE": 22,
    "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "TR": 26,
}

def _iban(others: str) -> str:
    """Countries of one length together, then all others with 15 to 34 characters; ``others`` stands before those."""
    by_length: dict[int, list[str]] = {}
    for country, n in IBAN_LENGTH.items():
        by_length.setdefault(n, []).append(country)
    known = [rf"(?:{'|'.join(c)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in by_length.items()]
    return f"(?:{'|'.join(known)}|{others}[A-Z]{{2}}[0-9]{{2}}(?:\\x20?[A-Z0-9]){{11,30}})"


#: The patterns of the kinds, in the order of the result. Starts within a run that has failed cannot
#: match either, so a look-behind and possessive repeats skip them: long runs take time in proportion, and no stack.
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9]){_iban(f'(?!{"|".join(IBAN_LENGTH)})')}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9])[0-9a-f]{32,64}(?![A-Za-z0-9])",
}
#: A text without any of these characters or patterns has no span of the kind; most texts are passed over by them.
HINTS = {
    "email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]-[0-9]{2}-[0-9]", "secret": "[0-9a-f]{32}",
}
BASE_KINDS = ("email", "ip", "card", "phone")
#: Score without context, words that raise it, and whether a span needs such a word to count.
CONTEXT = {
    "iban": (0.8, "iban|account|konto|cuenta|compte|bank", False),
    "ssn": (0.3, "ssn|social|security|tax", True),
    "secret": (0.4, "token|secret|key|password|passwd|credential", True),
}
CONTEXT_CHARS = 40
BONUS = 0.4
ACCEPT = 0.6
#: Matches that are put together at a time: work per match stays the same however many a text has.
GROUP = 128
#: Matches of context kinds have 11 characters or more, so that four on each side cover CONTEXT_CHARS.
SIDE = 4


def digit_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string: from the right, every second digit doubled, less 9 if above 9."""
    chars = F.reverse(F.split(digits, ""))
    term = lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + (c.cast("int") * 2 / 10).cast("int"))
    return F.aggregate(F.transform(chars, term), F.lit(0), lambda a, x: a + x)


def mod97(iban: Column) -> Column:
    """Remainder of the number that an IBAN stands for: its head put last, letters as 10 to 35."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    value = lambda c: F.conv(c, 36, 10).cast("int")
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: (a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97)


def holds(kind: str, m: Column) -> Column:
    """Whether the check of a kind confirms the matched text."""
    if kind == "ip":
        small = lambda part: F.regexp_replace(part, "^0+(?=.)", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
        return F.forall(F.split(m, r"\."), small)
    if kind == "card":
        digits = F.regexp_replace(m, "[^0-9]", "")
        return F.when(F.length(digits).between(16, 19), digit_sum(digits) % 10 == 0).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(8, 15)
    if kind == "iban":
        bare = F.regexp_replace(m, " ", "")
        return F.when(F.length(bare).between(15, 34), mod97(bare) == 1).otherwise(F.lit(False))
    if kind == "ssn":
        return ~m.rlike("^(000|666|9..)|-00-|-0000$")
    return F.lit(True)


ITEM = "struct<skip:int,size:int,ok:boolean,score:double,value:string>"
SPAN = "struct<kind:string,start:int,end:int,score:double,value:string>"


def items_of(kind: str, text: Column) -> Column:
    """All matches of a kind: characters since the last one, and its own; whether it counts, its score, and what counts of it."""
    matches, gaps = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), 0), F.split(text, PATTERNS[kind], -1)
    columns = [gaps.alias("gap"), matches.alias("m")]
    if kind in CONTEXT:
        for k in range(1, SIDE + 1):
            nulls = F.array_repeat(F.lit(None).cast("string"), k)
            columns += [F.concat(nulls, gaps).alias(f"gb{k}"), F.concat(nulls, matches).alias(f"mb{k}")]
            columns += [F.slice(gaps, k + 1, 1 << 30).alias(f"ga{k}"), F.slice(matches, k + 1, 1 << 30).alias(f"ma{k}")]

    def item(p: Column) -> Column:
        m = p["m"]
        ok, score = holds(kind, m), F.lit(1.0)
        if kind in CONTEXT:
            base, words, _ = CONTEXT[kind]
            n = F.lit(CONTEXT_CHARS)
            before = F.right(F.concat_ws("", *(x for k in range(SIDE, 0, -1) for x in (F.right(p[f"gb{k}"], n), p[f"mb{k}"])), F.right(p["gap"], n)), n)
            after = F.left(F.concat_ws("", *(x for k in range(1, SIDE + 1) for x in (F.left(p[f"ga{k}"], n), p[f"ma{k}"]))), n)
            near = F.concat_ws("", before, m, after).rlike(f"(?i)(?<![a-z])(?:{words})(?![a-z])")
            score = F.least(F.lit(base) + F.when(near, F.lit(BONUS)).otherwise(F.lit(0.0)), F.lit(1.0))
            ok = ok & (score >= ACCEPT)
        return F.struct(F.length(p["gap"]).alias("skip"), F.length(m).alias("size"), F.coalesce(ok, F.lit(False)).alias("ok"), score.alias("score"), m.alias("value")).cast(ITEM)

    found = F.transform(F.filter(F.arrays_zip(*columns), lambda p: p["m"].isNotNull()), item)
    return F.when(text.rlike(HINTS[kind]), found).otherwise(F.array().cast(f"array<{ITEM}>"))


def groups_of(items: Column) -> Column:
    """An array cut into arrays of GROUP."""
    starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(GROUP))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.slice(items, s, GROUP))


def running(values: Column, first: Column, join) -> Column:
    """For each of an array's values what ``join`` makes of those before it."""
    state = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(values, state, lambda s, x: F.struct(join(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])


def spans_of(kind: str, groups: Column) -> Column:
    """Array of (kind, start, end, score, value), in order; start and end in code points, end exclusive."""
    sizes = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda a, p: a + p["skip"] + p["size"]))
    offsets = running(sizes, F.lit(0), lambda a, x: a + x)

    def step(state: Column, p: Column) -> Column:
        at = state["at"] + p["skip"]
        row = F.struct(F.lit(kind).alias("kind"), at.alias("start"), (at + F.length(p["value"])).alias("end"), p["score"].alias("score"), p["value"].alias("value"))
        found = F.when(p["ok"], F.concat(state["found"], F.array(row.cast(SPAN)))).otherwise(state["found"])
        return F.struct((at + p["size"]).alias("at"), found.alias("found"))

    start = lambda o: F.struct(o.alias("at"), F.array().cast(f"array<{SPAN}>").alias("found"))
    return F.flatten(F.zip_with(groups, offsets, lambda g, o: F.aggregate(g, start(o), step, lambda s: s["found"])))


def spare_name(docs: DataFrame) -> str:
    """A beginning that no column's name has."""
    name = "_pii"
    while any(c.lower().startswith(name) for c in docs.columns):
        name = "_" + name
    return name


def find_pii(docs: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = tuple(PATTERNS), out: str = "pii_spans") -> DataFrame:
    """Add ``out``: array of (kind, start, end, score, value), by kind as listed, then by start; a column of that name is replaced.

    Email, ip, card and phone are the base kinds; card is confirmed by Luhn, iban by mod 97, ssn and secret only with a
    context word within ``CONTEXT_CHARS`` characters. Null and empty texts give an empty array. Works row by row, so
    repeated rows and ties play no part, and no other column is read or changed; the cost follows the text's length.
    """
    text, own = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), spare_name(docs)
    kept = [F.col(f"`{c}`") for c in docs.columns if c != out]
    d = docs.withColumns({f"{own}_i_{k}": items_of(k, text) for k in kinds})
    d = d.withColumns({f"{own}_g_{k}": groups_of(F.col(f"{own}_i_{k}")) for k in kinds})
    return d.select(*kept, F.concat(*(spans_of(k, F.col(f"{own}_g_{k}")) for k in kinds)).alias(out))


def render(spans: Column) -> Column:
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, text), ",")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace every span by its kind in angle brackets, overlapping ones as one by the first; null stays null.

    All other columns stay as they are. A text with many spans is put together from groups of them.
    """
    own = spare_name(docs)
    spans, groups, text = F.col(f"{own}_spans"), F.col(f"{own}_groups"), F.col(f"`{text_col}`")
    d = find_pii(docs, text_col, out=f"{own}_spans")
    d = d.withColumn(f"{own}_spans", F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("s"), (-s["end"]).alias("e"), s["kind"].alias("k")))))
    d = d.withColumn(f"{own}_groups", groups_of(spans))
    # where the text that is not yet done begins, for each group
    ends = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda a, s: F.greatest(a, -s["e"])))
    offsets = running(ends, F.lit(0), lambda a, x: F.greatest(a, x))

    def group(g: Column, o: Column) -> Column:
        last = F.aggregate(g, o, lambda a, s: F.greatest(a, -s["e"]))
        state = F.struct(o.alias("at"), F.lit("").alias("out"), F.substr(text, o + 1, last - o).alias("t"))

        def step(state: Column, s: Column) -> Column:
            piece = F.concat(state["out"], F.substr(state["t"], state["at"] - o + 1, s["s"] - state["at"]), F.lit("<"), F.upper(s["k"]), F.lit(">"))
            return F.struct(F.greatest(state["at"], -s["e"]).alias("at"), F.when(s["s"] >= state["at"], piece).otherwise(state["out"]).alias("out"), state["t"].alias("t"))

        return F.aggregate(g, state, step, lambda s: s["out"])

    end = F.aggregate(groups, F.lit(0), lambda a, g: F.aggregate(g, a, lambda b, s: F.greatest(b, -s["e"])))
    whole = F.concat(F.array_join(F.zip_with(groups, offsets, group), ""), F.substr(text, end + 1))
    return d.withColumn(text_col, F.when(F.size(spans) > 0, whole).otherwise(text)).select(*(F.col(f"`{c}`") for c in docs.columns))


PII_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k(kind, o, pat) AS (VALUES ('email', 0, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'), ('ip', 1, '[0-9]+(?:\.[0-9]+){3}'),
  ('card', 2, '[0-9](?:[\x20-]?[0-9])+'), ('phone', 3, '\+[0-9][\x20().0-9-]+[0-9]'),
  ('iban', 4, 'IBAN'), ('ssn', 5, '[0-9]{3}-[0-9]{2}-[0-9]{4}'), ('secret', 6, '[0-9a-f]{32,64}')),
m AS (SELECT doc_id, t, kind, o, regexp_extract_all(t, pat) AS ms, regexp_split_to_array(t, pat) AS gs FROM d CROSS JOIN k WHERE regexp_matches(t, pat)),
e AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM m),
p AS (SELECT doc_id, t, kind, o, ms[i] AS v,
  CAST(list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS s FROM e),
c AS (SELECT *, CASE WHEN kind = 'iban' THEN MAP LENGTHS[substr(v, 1, 2)] END AS n FROM p),
q AS (SELECT *, s + length(v) AS f, regexp_replace(v, '[^0-9]', '', 'g') AS dig, substr(t, CAST(s AS BIGINT), 1) AS pre,
  substr(t, s + length(v) + 1, 1) AS post, regexp_replace(v, ' ', '', 'g') AS bare,
  substr(t, greatest(1, s + 1 - 40), s + length(v) + 40 - greatest(1, s + 1 - 40) + 1) AS around FROM c WHERE v <> ''),
ok AS (SELECT *, CASE kind WHEN 'email' THEN true
  WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda x: NOT regexp_matches(x, '^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$'))) = 0
  WHEN 'card' THEN length(dig) BETWEEN 16 AND 19 AND CAST(list_sum(list_transform(range(1, length(dig) + 1), lambda j:
     CASE WHEN (length(dig) - j) % 2 = 0 THEN CAST(substr(dig, j, 1) AS INT)
          ELSE (CAST(substr(dig, j, 1) AS INT) * 2) % 10 + (CAST(substr(dig, j, 1) AS INT) * 2) // 10 END)) AS BIGINT) % 10 = 0
  WHEN 'phone' THEN length(dig) BETWEEN 8 AND 15
  WHEN 'iban' THEN coalesce(length(bare) = n, true) AND NOT regexp_matches(pre, '[A-Za-z0-9]') AND NOT regexp_matches(post, '[A-Za-z0-9]') AND length(bare) BETWEEN 15 AND 34 AND
     list_reduce(list_prepend(0, list_transform(string_split(substr(bare, 5) || substr(bare, 1, 4), ''), lambda c: CAST(strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1 AS BIGINT))),
       lambda a, c: (a * (CASE WHEN c > 9 THEN 100 ELSE 10 END) + c) % 97) = 1
  WHEN 'ssn' THEN s >= 0 AND NOT regexp_matches(pre, '[0-9-]') AND NOT regexp_matches(post, '[0-9-]') AND NOT regexp_matches(v, '^(000|666|9..)|-00-|-0000$')
     AND regexp_matches(around, '(?i)(^|[^a-z])(ssn|social|security|tax)([^a-z]|$)')
  ELSE NOT regexp_matches(pre, '[A-Za-z0-9]') AND NOT regexp_matches(post, '[A-Za-z0-9]')
     AND regexp_matches(around, '(?i)(^|[^a-z])(token|secret|key|password|passwd|credential)([^a-z]|$)') END AS good FROM q),
g AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card,
  count(*) FILTER (kind = 'phone') AS n_phone, string_agg(kind || ':' || s || ':' || f, ',' ORDER BY o, s) FILTER (o < 4) AS base,
  string_agg(kind || ':' || s || ':' || f, ',' ORDER BY o, s) AS spans FROM ok WHERE good GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)
""".replace("LENGTHS", str(IBAN_LENGTH)).replace("'IBAN'", f"'{_iban('')}'")
