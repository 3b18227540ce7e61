"""Personal data by candidate gradient boosting (operator 8).

Generators (regular expressions, wide on purpose) propose spans, which may
overlap. The four base kinds stand if their check holds (Luhn, number of
digits, parts of an address). Every other candidate gets features of its format
and context, boosted trees score it, and the threshold that reached the wanted
precision on held-out examples decides. A chosen span that overlaps a base span
gives way; of the others the best score is taken first, then each that overlaps
none taken.

All of it is DataFrame functions in one lineage: a scan, the candidates as rows,
one shuffle by row id for their places, and an aggregate per row. Regular
expressions are possessive and anchored at the ends of runs, so that they stay
linear on long texts; a match's place is the length of what stands before it.
The trees are fitted on the driver on generated examples of fixed number and
become a SQL expression.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from settlebook.llm import boosting
from settlebook.llm.scratch import Scratch
from settlebook.operators.split import split_by_keys

# Base kinds in their order, and their patterns (possessive forms of the contract's).
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further generators: kind, pattern, and what a text must hold for the pattern to be tried.
EXTRA = {
    "email_words": ("email", r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\s?(?:\(at\)|\[at\]|\{at\}|\sat\s)\s?[a-z0-9-]{1,63}+"
                             r"(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|\sdot\s|\.)\s?[a-z0-9-]{2,63}+){1,5}+",
                    r"(?i)[(\[{]at[)\]}]|\sat\s"),
    "phone_local": ("phone", r"(?<![0-9A-Za-z+.,/-])(?:\([0-9]{2,5}\)|[0-9]{2,5}+)(?:[\x20./-][0-9]{2,5}+){1,4}+(?![0-9A-Za-z])",
                    r"[0-9)][\x20./-][0-9]"),
    "identity": ("id", r"(?<![0-9A-Za-z])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?+)"
                       r"(?![0-9A-Za-z])", r"[0-9]{3}-[0-9]{2}-|[A-Z]{2}[0-9]{2}"),
    # Numbers that stand side by side, which the base pattern takes for one that is too long.
    "card_apart": ("card", r"(?<![0-9])(?:[0-9]{16,19}+|[0-9]{4}(?:[\x20-][0-9]{4}){3}+)(?![0-9])", r"[0-9]{16}|(?:[0-9]{4}[\x20-]){3}[0-9]{4}"),
    "secret_named": ("secret", r"(?i)(?<![a-z0-9])(?:pass(?:word|wd|phrase)?|pwd|token|secret|api[_\x20-]?key|credentials?)"
                               r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?[^\s\"',;<>]{6,}+", r"[=:]"),
    "secret_key": ("secret", r"(?<![0-9A-Za-z_+/=-])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}+|sk-[0-9A-Za-z_-]{20,}+"
                             r"|(?=[0-9]*+[a-f])(?=[a-f]*+[0-9])[0-9a-f]{32,}+)"
                             r"(?![0-9A-Za-z_])", r"AKIA|gh[pousr]_|sk-|[0-9a-f]{32}"),
}
GENERATORS = [*BASE, *EXTRA]
KINDS = ["email", "ip", "card", "phone", "id", "secret"]
CONTEXT = 40  # characters on either side
NEAR = {"near_phone": "tel|phone|fon|call|fax|mobile|cell|handy|whatsapp|numéro|teléfono|llame|anruf|ruf|contact|appel",
        "near_mail": "mail|write|contact|courriel|correo|schreib|reach",
        "near_id": "ssn|social|iban|account|konto|cuenta|compte|passport|identity|tax",
        "near_secret": "key|pass|token|secret|login|aws|credential",
        "near_other": "date|page|version|isbn|price|order|invoice|section|chapter|score|year|born|since|release|build|total|"
                      "datum|seite|preis|kapitel|prix|página|precio|article|vol|no\\."}
MONEY = r"^\s*(?:%|€|\$|£|kg|km|cm|mm|ml|mb|gb|usd|eur|percent|units?|items?|points?|pages?)"
FEATURES = [*(f"g_{g}" for g in EXTRA), "n_chars", "n_digits", "n_groups", "n_upper", "n_lower", "n_kinds", "n_first", "n_last",
            "has_paren", "has_slash", "has_dot", "has_space", "is_date", "is_year_range", "is_isbn", "is_thousands", "is_code",
            "is_hex", "is_luhn", "mixed", *NEAR, "then_unit", "after_money"]


def _luhn(digits: Column) -> Column:
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(c == "", 0).otherwise(
        F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def _base_holds(kind: str) -> Column:
    digits = F.regexp_replace("match", "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split("match", r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(
            "^(?:[0-9]?[0-9]?|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(digits).between(16, 19) & F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def candidates(texts: DataFrame, outer: bool = True) -> DataFrame:
    """A row per candidate: the columns of ``texts`` but for ``t``, and
    ``generator, i, skipped, match, before, after``; with ``outer``, a row
    without a generator for a text that has none."""
    keys = [c for c in texts.columns if c != "t"]
    rows, found = texts, []
    kind = "array<struct<generator:string,i:int,skipped:int,match:string,before:string,after:string>>"
    for g in GENERATORS:
        pattern, hint = (BASE[g], {"email": "@", "phone": r"\+[0-9]"}.get(g, "[0-9]")) if g in BASE else EXTRA[g][1:]
        rows = rows.withColumn("m", F.when(F.col("t").rlike(hint), F.regexp_extract_all("t", F.lit(pattern), F.lit(0)))
                               .otherwise(F.array().cast("array<string>")))
        rows = rows.withColumn("s", F.when(F.size("m") > 0, F.split("t", pattern, -1)).otherwise(F.array().cast("array<string>")))
        rows = rows.withColumn(f"c_{g}", F.transform("m", lambda m, i: F.struct(
            F.lit(g).alias("generator"), i.alias("i"), F.length(F.get("s", i)).alias("skipped"), m.alias("match"),
            F.right(F.get("s", i), F.lit(CONTEXT)).alias("before"), F.left(F.get("s", i + 1), F.lit(CONTEXT)).alias("after"))).cast(kind))
        rows = rows.drop("m", "s")
        found.append(f"c_{g}")
    all_of = rows.select(*keys, F.concat(*found).alias("c"))
    return all_of.select(*keys, (F.explode_outer if outer else F.explode)("c").alias("c")).select(*keys, "c.*")


def features() -> dict[str, Column]:
    """Format and context of a candidate, as numbers."""
    m, low = F.col("match"), F.lower("match")

    def has(pattern: str, of: Column = m) -> Column:
        return of.rlike(pattern)

    f = {f"g_{g}": F.col("generator") == g for g in EXTRA}
    f |= {
        "n_chars": F.length(m), "n_digits": F.length(F.regexp_replace(m, "[^0-9]", "")),
        "n_groups": F.size(F.split(m, "[^0-9A-Za-z]+")), "n_upper": F.length(F.regexp_replace(m, "[^A-Z]", "")),
        "n_lower": F.length(F.regexp_replace(m, "[^a-z]", "")),
        "n_kinds": F.size(F.array_distinct(F.split(m, ""))), "n_first": F.length(F.regexp_extract(m, "[0-9]+", 0)),
        "n_last": F.length(F.regexp_extract(m, "[0-9]*$", 0)),
        "has_paren": has(r"[(\[{]"), "has_slash": has("/"), "has_dot": has(r"\."), "has_space": has(" "),
        "is_date": has(r"^(?:[12][0-9]{3}[./-][01]?[0-9][./-][0-3]?[0-9]|[0-3]?[0-9][./-][0-3]?[0-9][./-](?:[12][0-9])?[0-9]{2})$"),
        "is_year_range": has(r"^[12][0-9]{3}[ ./-][12][0-9]{3}$"), "is_isbn": has(r"^97[89][ -]"),
        "is_thousands": has(r"^[0-9]{2,3}(?:[ .][0-9]{3})+$"), "is_code": has("AKIA|gh[pousr]_|sk-"),
        "is_hex": has("^[0-9a-f]{32,}$"),
        "is_luhn": F.when(F.col("generator") == "card_apart", _luhn(F.regexp_replace(m, "[^0-9]", ""))),
        "mixed": has(r"[0-9]", F.regexp_extract(m, r"[=:]\s*[\"']?(.*)$", 1)),
        "then_unit": has(MONEY, F.lower("after")), "after_money": has(r"[€$£#]\s*$", F.col("before")),
    }
    f |= {name: has(f"(?:{words})[^.!?]*$", F.lower("before")) | (F.lit(name == "near_secret") & has(f"^(?:{words})", low))
          for name, words in NEAR.items()}
    return {name: F.coalesce(f[name].cast("double"), F.lit(0.0)) for name in FEATURES}


def examples(number: int = 2000, seed: int = 11) -> list[tuple[str, str]]:
    """Generated texts that hold one candidate each, and the kind of personal data it is (empty: none)."""
    r = random.Random(seed)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    d1 = lambda n: r.choice("123456789") + d(n - 1)
    name = lambda: "".join(r.choice(("an", "be", "lo", "mir", "ka", "ste", "ron", "ul", "vi", "do")) for _ in range(r.randint(2, 4)))
    word = lambda: r.choice(("it", "was", "there", "der", "und", "pour", "les", "que", "sobre", name(), name()))
    mixed = lambda n: "".join(r.choice("abcdefghkmnpqrstuvwxyz23456789") for _ in range(n - 2)) + d(2)

    def long_number(valid: bool, n: int = 16) -> str:
        head = d1(n - 1)
        total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(head)))
        last = (-total % 10 + (0 if valid else r.randint(1, 9))) % 10
        return f"{head}{last}"

    four = lambda s: "".join(c + (" " if i % 4 == 3 and i < 15 else "") for i, c in enumerate(s))
    at, dot = lambda: r.choice((" at ", "(at)", " [at] ", "[at]")), lambda: r.choice((" dot ", "(dot)", "[dot]", "."))
    yes = [
        ("phone", lambda: f"{r.choice(('call', 'tel', 'phone:', 'mobile', 'fax', 'Anruf', 'appel'))} {r.choice((f'({d1(3)}) {d(3)}-{d(4)}', f'0{d(2)}-{d(4)}-{d(4)}', f'{d1(3)}-{d(3)}-{d(4)}', f'0{d1(1)} {d(2)} {d(2)} {d(2)} {d(2)}'))}"),
        ("phone", lambda: r.choice((f"({d1(3)}) {d(3)}-{d(4)}", f"{d1(3)}-{d(3)}-{d(4)}", f"0{d1(3)}/{d(3)} {d(4)}"))),
        ("email", lambda: f"{name()}.{name()}{r.choice((' at ', '(at)', ' [at] '))}{name()}{r.choice((' dot ', '(dot)', '[dot]'))}{r.choice(('com', 'org', 'net', 'de'))}"),
        ("email", lambda: f"{r.choice(('mail', 'write to', 'contact'))} {name()}{at()}{name()}{r.choice((' dot ', '(dot)', '[dot]'))}com"),
        ("email", lambda: f"{r.choice(('mail', 'write to', 'contact', ''))} {name()}.{name()}{at()}{name()}{dot()}{name()}{dot()}{r.choice(('com', 'org', 'fr'))}"),
        ("id", lambda: f"{r.choice(('ssn', 'social security', 'SSN:'))} {d1(3)}-{d(2)}-{d(4)}"),
        ("id", lambda: f"{r.choice(('IBAN', 'account', 'Konto', ''))} {r.choice(('DE', 'FR', 'GB', 'ES'))}{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}"),
        ("secret", lambda: f"{r.choice(('password', 'token', 'secret', 'api_key', 'pwd'))}{r.choice(('=', ': ', ' = '))}{r.choice(('', chr(34)))}{mixed(r.randint(10, 40))}"),
        ("secret", lambda: f"AKIA{''.join(r.choice('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') for _ in range(16))}"),
        ("secret", lambda: f"{r.choice(('key', 'token', 'secret'))} {''.join(r.choice('0123456789abcdef') for _ in range(40))}"),
        ("card", lambda: " ".join(r.choice((long_number(True), four(long_number(True)))) for _ in range(r.randint(1, 3)))),
        ("card", lambda: f"{r.choice(('card', 'visa', 'pay', 'numbers'))} {long_number(True)} {long_number(True, r.choice((16, 16, 19)))}"),
    ]
    no = [
        lambda: f"{r.choice(('date', 'on', 'since', 'Datum'))} {r.choice((f'20{d(2)}-0{d1(1)}-1{d(1)}', f'1{d(1)}.0{d1(1)}.19{d(2)}', f'1{d(1)}/0{d1(1)}/20{d(2)}'))}",
        lambda: f"{r.choice(('from', 'in', 'years'))} 19{d(2)}-20{d(2)}",
        lambda: f"{r.choice(('price', 'total', 'Preis', ''))} {d1(2)} {d(3)} {d(3)} {r.choice(('€', 'units', 'km', 'usd'))}",
        lambda: f"ISBN 978-{d1(1)}{d(1)}-{d(4)}-{d(4)}",
        lambda: f"{r.choice(('version', 'release', 'build'))} {d1(2)}.{d(2)}.{d(4)}",
        lambda: f"{r.choice(('page', 'score', 'chapter', 'section', 'pages'))} {d1(2)}-{d(2)}",
        lambda: f"{r.choice(('order', 'invoice', 'article'))} {d1(4)}-{d(4)}-{d(3)}",
        lambda: f"{name()} {r.choice(('at', 'at'))} {name()} dot {name()} dot {name()} {word()}",
        lambda: f"{r.choice(('part', 'order', 'serial'))} {d1(3)}-{d(2)}-{d(4)}",
        lambda: f"{r.choice(('password', 'token', 'secret', 'pass', 'key'))}: {r.choice(('required', 'forgotten', 'optional', 'something', 'unknown', 'because'))}",
        lambda: f"{r.choice(('commit', 'md5', 'checksum', 'sha1'))} {''.join(r.choice('0123456789abcdef') for _ in range(32))}",
        lambda: f"{d1(2)} {d(2)} {d(2)} {word()}",
        lambda: " ".join(r.choice((long_number(False), four(long_number(False)))) for _ in range(r.randint(1, 3))),
        lambda: f"{r.choice(('order', 'serial', 'card', 'id'))} {long_number(False)} {long_number(False, r.choice((16, 17, 19)))}",
    ]
    out = []
    for i in range(number):
        kind, make = r.choice(yes) if i % 2 else ("", r.choice(no))
        text = make()
        out.append((f"{' '.join(word() for _ in range(r.randint(0, 5)))}. {text} {word()} {word()}.", kind))
    return out


def model(spark: SparkSession, precision: float = 0.97, number: int = 2000) -> tuple[str, float]:
    """SQL of the score and its threshold. The examples (``number`` short texts,
    half of them to fit, half to calibrate) go through the same generators and
    feature expressions as the documents."""
    made = examples(number)
    texts = spark.range(1).select(F.posexplode(F.split(F.lit("\x01".join(t for t, _ in made)), "\x01")).alias("id", "t"))
    rows = candidates(texts, outer=False).where(F.col("generator").isin(*EXTRA)).select("id", "generator", *(c.alias(n) for n, c in features().items())).collect()
    rows.sort(key=tuple)
    x = np.array([[r[n] for n in FEATURES] for r in rows])
    y = np.array([made[r["id"]][1] == EXTRA[r["generator"]][0] for r in rows], dtype=float)  # of another kind: not right either
    fold = np.array([r["id"] // 2 % 2 for r in rows])
    trees = boosting.fit(x[fold == 0], y[fold == 0])
    score = boosting.scores(trees, x[fold == 1])
    return boosting.sql(trees, FEATURES), max(0.5, boosting.threshold(score, y[fold == 1], precision))


_MODELS: dict[str, tuple[str, float]] = {}  # per application: fitted once


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", row: str | None = None,
         trained: tuple[str, float] | None = None) -> DataFrame:
    """``rid, <key>, spans`` per row of ``docs``: an array of ``kind (0 to 5, in
    the order of KINDS), start, end, base, score``, sorted; places in code points.

    Null texts count as empty. ``row`` names a column that identifies rows,
    else the operator numbers them; null and repeated keys pass through;
    columns that are not named are not read.
    """
    spark = docs.sparkSession
    app = spark.conf.get("spark.app.id", "")
    if trained is None:
        if app not in _MODELS:
            _MODELS[app] = model(spark)
        trained = _MODELS[app]
    score, least = trained
    rid = F.col(row) if row else F.monotonically_increasing_id()
    c = candidates(docs.select(rid.alias("rid"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t")))
    end = F.sum(F.col("skipped") + F.length("match")).over(Window.partitionBy("rid", "generator").orderBy("i"))
    base = F.col("generator").isin(*BASE)
    holds = F.lit(False)
    for k in BASE:
        holds = F.when(F.col("generator") == k, _base_holds(k)).otherwise(holds)
    # checks and scores before the shuffle; places after it, over all candidates
    c = c.select("*", *(F.when(~base, e).alias(n) for n, e in features().items()))
    c = c.withColumn("score", F.when(base, holds.cast("double")).otherwise(F.expr(score)))
    c = c.select("rid", "key", "generator", "i", "skipped", "match", "score").repartition("rid")
    c = c.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))
    kinds = F.create_map(*[F.lit(v) for g in GENERATORS for v in (g, KINDS.index(g if g in BASE else EXTRA[g][0]))])
    c = c.select("rid", "key", kinds[F.col("generator")].alias("kind"), "start", "end", base.alias("base"), "score",
                 (F.col("generator").isNotNull() & F.when(base, F.col("score") == 1).otherwise(F.col("score") >= least)).alias("good"))
    c = c.withColumn("good", F.coalesce("good", F.lit(False)))
    # overlaps with base spans, then among the others
    w = Window.partitionBy("rid").orderBy("start", "end")
    fixed = F.col("base") & F.col("good")
    c = c.withColumn("reached", F.max(F.when(fixed, F.col("end"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    c = c.withColumn("ahead", F.min(F.when(fixed, F.col("start"))).over(w.rowsBetween(0, Window.unboundedFollowing)))
    clash = F.coalesce(F.col("reached") > F.col("start"), F.lit(False)) | F.coalesce(F.col("ahead") < F.col("end"), F.lit(False))
    c = c.withColumn("good", F.col("good") & (F.col("base") | ~clash))
    extra = F.col("good") & ~F.col("base")
    c = c.withColumn("before", F.max(F.when(extra, F.col("end"))).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    c = c.withColumn("cluster", F.sum(F.when(extra & F.coalesce(F.col("start") >= F.col("before"), F.lit(True)), 1).otherwise(0)).over(w))
    span = F.struct("kind", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "base", "score")
    ranked = F.struct((-F.col("score")).alias("rank"), "start", "end", span.alias("span"))
    each = c.groupBy("rid", "cluster").agg(F.first("key").alias("key"), F.collect_list(F.when(F.col("good") & F.col("base"), span)).alias("fixed"),
                                           F.array_sort(F.collect_list(F.when(extra, ranked))).alias("added"))
    # the best first, then each that overlaps none taken
    taken = F.aggregate("added", F.array().cast("array<struct<kind:int,start:bigint,end:bigint,base:boolean,score:double>>"), lambda kept, x: F.when(
        F.exists(kept, lambda y: (y["start"] < x["span"]["end"]) & (x["span"]["start"] < y["end"])), kept).otherwise(F.concat(kept, F.array(x["span"]))))
    each = each.select("rid", "key", F.concat("fixed", taken).alias("spans"))
    return each.groupBy("rid").agg(F.first("key").alias(key), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def described(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.end)), ",")


def redact(docs: DataFrame, scratch: Scratch, text: str = "text") -> DataFrame:
    """``docs`` with each span in ``text`` replaced by its kind in brackets.

    Spans belong to texts, so rows meet them by a digest of the text, and
    repeated rows need no care. Base spans of different kinds may overlap; a
    span that starts inside the one before only adds what lies beyond it.
    """
    digest, mine, found = "_settlebook_digest", "_settlebook_text", "_settlebook_spans"  # names that no input column has
    texts = docs.select(F.md5(text).alias(digest), F.col(text).alias("t"))
    spans = find(texts, digest, "t").where(F.size("spans") > 0).select(F.col(digest).alias(mine), F.col("spans").alias(found))
    spans = scratch.save(spans.dropDuplicates([mine]), "spans")
    # most texts have no spans: their rows stay where they are
    clean, others = split_by_keys(docs.withColumn(digest, F.md5(text)), digest, spans, mine)
    joined = others.join(spans, F.col(digest) == F.col(mine), "left")
    names = F.array(*map(F.lit, KINDS))
    by_place = F.array_sort(F.transform(found, lambda s: F.struct(s.start, s.end, s.kind)))
    # every span brings the text between it and the furthest end so far
    parts = F.aggregate(
        by_place, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, s: F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], F.array(
            F.when(s["start"] >= a["at"], F.concat(F.substring(F.col(text), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                                                   F.lit("["), F.upper(F.get(names, s["kind"])), F.lit("]"))).otherwise(F.lit("")))).alias("out")),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(F.col(text), (a["at"] + 1).cast("int"), F.length(text))))
    redacted = F.when(F.col(found).isNull(), F.col(text)).otherwise(parts)
    return clean.drop(digest).unionByName(joined.withColumn(text, redacted).drop(digest, found, mine))
