"""Secret scans: candidates by pattern, false positives removed by a random forest, all in DataFrame functions.

The forest is grown on the driver from a bounded table of labelled findings,
whose features the same expressions compute, and is then laid out in arrays that
each candidate walks down level by level, so the scan itself runs in the JVM only.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_of

#: How known kinds of keys begin.
PREFIX = "AKIA|ASIA|AIza|gh[pousr]_|github_pat_|sk_live_|sk-|xox[abpr]-|eyJ|glpat-"
# Between a telling name and its value: quotes and a few blanks around one sign.
_SIGN = r"[\"']?[ \t]{0,3}[=:][ \t]{0,3}"
_KEY = r"token|(?:api|access|secret|private)[_-]?key"
#: What may be a secret: the value after a telling name, a token of 16 characters or more with a digit or a known
#: beginning, a private key with its body. Every repetition has a bound or is possessive, so that no text makes the search slow.
PATTERN = (
    r"(?<=[=: \t\"'])(?<=[=:][ \t]{0,3}[\"']?)(?i:"
    rf"(?<=(?:password|passwd|secret|pwd){_SIGN}[\"']?)[^\s\"'<>|,;]{{8,}}+"
    rf"|(?<=(?:{_KEY}){_SIGN}[\"'])[^\s\"'<>|,;]{{8,}}+"
    rf"|(?<=(?:{_KEY}){_SIGN})[a-z0-9_+/-]{{8,}}+={{0,2}})"
    rf"|(?<![A-Za-z0-9_+/-])(?=(?:{PREFIX})|[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{{16,}}+={{0,2}}"
    r"|-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s:,]*+-----END [A-Z ]{0,40}PRIVATE KEY-----)?+"
)
#: Characters of context that features see on either side.
CONTEXT = 48
#: At most so many labelled findings are read for training; trees, their depth, and candidate features of a split.
TRAIN_ROWS, TREES, DEPTH, TRIES, SEED = 4_000, 15, 6, 5, 7
#: The share of votes from which a candidate is a secret.
CUT = 0.5
# Short words and word parts of running text, and words that tell of a secret or of an example.
DICTIONARY = "tion ment ing the and ent ion ter est ers ati hat ate all eth his ver our ith you pass word user name test data file path http www com org net de la le que der die und ein ich sch con los las del par les des est".split()
TELLING = "password|passwd|secret|token|api.?key|access.?key|credential|bearer|authorization|private.?key|pwd"
EXAMPLE = "example|sample|dummy|placeholder|changeme|your|xxxx|fake|test"
INNOCENT = "commit|sha1|sha256|md5|checksum|digest|etag|uuid|order|invoice|card|phone|serial|isbn|revision|hash|http"
FEATURES = ("length", "digits", "upper", "lower", "marks", "hex_only", "digits_only", "runs", "vowels", "letter_pairs", "dictionary", "distinct", "prefix", "telling_left", "example_near", "innocent_left", "assigned", "quoted", "path_test", "words_beside")


def features(secret: Column, left: Column, right: Column, path: Column) -> list[Column]:
    """The features of a candidate, in the order of ``FEATURES``, each a double."""
    size = F.greatest(F.length(secret), F.lit(1)).cast("double")
    drop = lambda pattern: F.length(F.regexp_replace(secret, pattern, "")).cast("double")
    share = lambda kept: drop(kept) / size
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    low = F.lower(secret)
    return [
        size,
        share("[^0-9]"),
        share("[^A-Z]"),
        share("[^a-z]"),
        share("[A-Za-z0-9]"),
        flag(low.rlike("^[0-9a-f]+$")),
        flag(secret.rlike("^[0-9+]+$")),
        # character transitions: changes between small letters, capitals, digits and marks
        F.length(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(secret, "[a-z]+", "\u0001"), "[A-Z]+", "\u0002"), "[0-9]+", "\u0003"), "[^\u0001\u0002\u0003]+", "\u0004")) / size,
        share("(?i)[^aeiou]"),
        # transitions between a consonant and a vowel, as words have them
        1 - F.length(F.regexp_replace(low, "[bcdfghjklmnpqrstvwxyz][aeiou]", "")) / size,
        1 - F.length(F.regexp_replace(low, "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))), "")) / size,
        F.size(F.array_distinct(F.split(secret, ""))).cast("double") / size,
        flag(secret.rlike(f"^({PREFIX}|-----BEGIN)")),
        flag(left.rlike(f"(?i)({TELLING})[^a-z0-9]{{0,6}}$")),
        flag(F.concat(left, secret, right).rlike(f"(?i){EXAMPLE}")),
        flag(left.rlike(f"(?i)({INNOCENT})[^\\s]{{0,3}}\\s?$")),
        flag(left.rlike("[=:]\\s?[\"']?$")),
        flag(left.rlike("[\"'`]$")),
        flag(path.rlike("(?i)test|spec|example|doc|readme|fixture|mock")),
        F.length(F.regexp_replace(F.concat(left, right), "[^A-Za-z ]", "")).cast("double") / F.greatest(F.length(left) + F.length(right), F.lit(1)),
    ]


def labelled_findings(spark: SparkSession, n: int = 2_000) -> DataFrame:
    """``(secret, left, right, path, label, kind)``: a table of findings made by rule from hashes, half of them true.

    For use where no reviewed findings are at hand. True ones: named tokens,
    access keys, passwords, prefixed keys; false ones: digests, commits, card and
    order numbers, long words with digits, placeholders, paths.
    """
    h = lambda k: F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"/{k}")), 512)
    cap = lambda c: F.translate(F.upper(c), "01", "KZ")
    mixed = F.translate(F.base64(F.unhex(h("m"))), "=", "")
    word = F.translate(F.substring(h("w"), 1, 18), "0123456789abcdef", "entiosarlhduceaé"[:15] + "n")
    digits = F.translate(h("d"), "abcdef", "135792")
    prose = F.concat(F.translate(F.substring(h("p"), 1, 5), "0123456789abcdef", "theandofinrestol"), F.lit(" "), F.translate(F.substring(h("q"), 1, 7), "0123456789abcdef", "ionertheandsalme"), F.lit(" "))
    name = lambda *names: F.element_at(F.array(*map(F.lit, names)), (F.col("id") / 20 % len(names) + 1).cast("int"))
    none = F.lit("")
    kinds = [
        (F.substring(h(1), 1, 40), F.concat(prose, name("token", "api_key", "secret", "TOKEN", "auth_token"), name(' = "', "=", ": ", '="')), name('" ', " ", ";", '"!! '), 1),
        (F.upper(F.substring(h(1), 1, 40)), F.concat(F.upper(prose), F.lit('TOKEN = "')), F.lit('"!! '), 1),
        (F.concat(F.lit("AKIA"), cap(F.substring(mixed, 1, 16))), prose, F.lit(" "), 1),
        (F.translate(F.concat(F.lit("AKIA"), F.upper(F.substring(mixed, 3, 16))), "+/01", "ABCD"), F.upper(prose), name(" ", "!! ", "### "), 1),
        (F.substring(h(2), 1, 18), F.concat(prose, name("password=", "passwd=", "PASSWORD=", "pwd=")), name(" ", "!! ", "%%% "), 1),
        (F.concat(name("ghp_", "gho_", "sk_live_", "glpat-"), F.translate(F.substring(mixed, 1, 36), "+/", "xy")), F.concat(prose, name("token: ", "key = ", "", "Bearer ")), F.lit(" "), 1),
        (F.substring(mixed, 1, 40), F.concat(prose, name("secret_key = '", "aws_secret_access_key=", 'client_secret: "', "Authorization: Bearer ")), name("'", " ", '"', " "), 1),
        (F.concat(name("-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("\n"), mixed, F.lit("\n"), mixed, F.lit("\n-----END PRIVATE KEY-----"))).otherwise("")), none, F.lit("\nMII"), 1),
        (F.concat(F.substring(mixed, 1, 12), F.lit("!9")), F.concat(prose, F.lit("password=")), F.lit(" "), 1),
        (F.concat(F.lit("xoxb-"), F.substring(digits, 1, 12), F.lit("-"), F.translate(F.substring(mixed, 1, 24), "+/", "xy")), F.concat(prose, name("slack ", "token=", "", "bot ")), F.lit(" "), 1),
        (F.concat(F.substring(mixed, 1, 8), name("", "!x", "#", "")), F.concat(prose, name('password = "', "password: ", '"password": "', "token: ")), name('" ', " ", '"', " "), 1),
        (F.concat(F.substring(word, 1, 6), F.substring(digits, 1, 2), name("", "!", "", "4")), F.concat(prose, name("password: ", "password=", 'pwd = "', 'passwd: "')), name(" ", " ", '" ', '", '), 1),
        (F.translate(F.concat(F.lit("AKIA"), F.upper(F.substring(mixed, 5, 16))), "+/0123456789", "ABCDEFGHIJKL"), F.concat(prose, name("", "key = ", "id ", "")), F.lit(" "), 1),
        (F.substring(word, 1, 9), F.concat(prose, name("password: ", "secret: ", "token: ", "password = ")), F.lit(" "), 0),
        (F.concat(F.substring(word, 1, 5), name("_", "-", "/", "_"), F.substring(word, 6, 8)), F.concat(prose, name("token=", "password: ", 'token: "', "api_key: ")), F.lit(" "), 0),
        (F.substring(h(1), 1, 40), F.concat(prose, name("commit ", "revision ", "sha1:", "commit ")), F.lit(" "), 0),
        (F.substring(h(1), 1, 64), F.concat(prose, name("sha256:", "checksum ", "digest=", "sha256 ")), F.lit(" "), 0),
        (F.substring(digits, 1, 16), prose, F.lit(" "), 0),
        (F.concat(F.lit("+"), F.substring(digits, 1, 16)), F.concat(prose, F.lit("phone ")), F.lit(" "), 0),
        (F.concat(word, F.substring(digits, 1, 2)), prose, F.lit(" "), 0),
        (F.concat(F.initcap(word), F.lit("-"), F.substring(digits, 1, 4)), prose, F.lit(" "), 0),
        (F.concat(F.lit("AKIAIOSFODNN7"), name("EXAMPLE", "EXAMPLE", "SAMPLE1", "EXAMPLE")), F.concat(prose, F.lit("key = ")), F.lit(" "), 0),
        (name("your_password_123", "changeme12345678", "xxxxxxxxxxxxxxx1", "placeholder_0001"), F.concat(prose, F.lit("password=")), F.lit(" "), 0),
        (F.concat(F.lit("/"), F.substring(word, 1, 6), F.lit("/"), F.substring(word, 7, 9), F.lit("/"), F.substring(digits, 1, 5)), F.concat(prose, F.lit("http:")), F.lit(" "), 0),
        (F.concat_ws("-", F.substring(h(3), 1, 8), F.substring(h(3), 9, 4), F.substring(h(3), 13, 4), F.substring(h(3), 17, 4), F.substring(h(3), 21, 12)), F.concat(prose, name("uuid ", "order ", "id=", "invoice ")), F.lit(" "), 0),
    ]
    path = name("src/a.py", "web", "conf/x.yml", "notes").alias("path")
    out = None
    for i, (secret, left, right, y) in enumerate(kinds):  # a projection for each kind, small enough to be compiled
        own = spark.range(i, n, len(kinds), 1).select(secret.alias("secret"), left.alias("left"), F.concat(right, prose).alias("right"), path, F.lit(y).alias("label"), F.lit(i).alias("kind"))
        out = own if out is None else out.unionByName(own)
    return out


def grow(rows: list[tuple[list[float], int]], trees: int = TREES, depth: int = DEPTH, tries: int = TRIES, seed: int = SEED) -> list:
    """A random forest: bootstrap rows, a random choice of features at each split, Gini impurity. A tree is a share of
    true findings, or ``(feature, threshold, low, high)``. The rows' order does not matter."""
    rows = sorted(rows)
    rng = random.Random(seed)
    width = len(rows[0][0]) if rows else 0

    def node(own: list, level: int):
        n, true = len(own), sum(y for _, y in own)
        if level == depth or true in (0, n) or n < 4:
            return (true + 1) / (n + 2)
        best = None
        for f in rng.sample(range(width), min(tries, width)):
            values = sorted((x[f], y) for x, y in own)
            low = 0
            for i in range(1, n):
                low += values[i - 1][1]
                if values[i][0] != values[i - 1][0]:
                    a, b = low / i, (true - low) / (n - i)
                    impurity = i * a * (1 - a) + (n - i) * b * (1 - b)
                    if best is None or impurity < best[0]:
                        best = (impurity, f, (values[i][0] + values[i - 1][0]) / 2)
        if best is None:
            return (true + 1) / (n + 2)
        _, f, t = best
        return (f, t, node([r for r in own if r[0][f] <= t], level + 1), node([r for r in own if r[0][f] > t], level + 1))

    return [node([rows[rng.randrange(len(rows))] for _ in rows], 0) for _ in range(trees)] if rows else []


def _rows(findings: DataFrame, train_rows: int, *more: str) -> list:
    """``x``, ``y`` and ``more`` of at most about ``train_rows`` findings, picked by a hash."""
    c = lambda name: F.coalesce(F.col(name), F.lit(""))
    own = findings.filter("secret is not null and label is not null")
    n = own.count()
    part = own if n <= train_rows else own.filter(F.pmod(F.xxhash64("secret", "left", "right"), F.lit(1 << 30)) < int(train_rows / n * (1 << 30)))
    x = F.array(*features(c("secret"), F.right(c("left"), F.lit(CONTEXT)), F.left(c("right"), F.lit(CONTEXT)), c("path")))
    return part.select(x.alias("x"), F.col("label").cast("int").alias("y"), F.pmod(F.xxhash64("secret", "left"), F.lit(5)).alias("fold"), *more).collect()


def fit(findings: DataFrame, train_rows: int = TRAIN_ROWS) -> list:
    """Grow the forest from at most about ``train_rows`` of ``findings(secret, left, right, path, label)``, by hash.

    Rows with a null secret or label are ignored; other nulls count as empty.
    """
    return grow([(list(r["x"]), r["y"]) for r in _rows(findings, train_rows)])


def vote(forest: list, x: list[float]) -> float:
    """The forest's mean share for one candidate, on the driver."""
    total = 0.0
    for tree in forest:
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        total += tree
    return total / len(forest) if forest else 0.5


def evaluate(findings: DataFrame, train_rows: int = TRAIN_ROWS, cut: float = CUT) -> dict[int, tuple[int, float, float]]:
    """For each ``kind`` of findings its label, the share called a secret among a fifth kept from training, and that
    among all of the kind when no finding of it is trained on."""
    rows = _rows(findings, train_rows, "kind")
    share = lambda forest, own: sum(round(vote(forest, r["x"]), 6) >= cut for r in own) / max(1, len(own))
    whole = grow([(list(r["x"]), r["y"]) for r in rows if r["fold"]])
    out = {}
    for kind in sorted({r["kind"] for r in rows}):
        own = [r for r in rows if r["kind"] == kind]
        rest = grow([(list(r["x"]), r["y"]) for r in rows if r["kind"] != kind])
        out[kind] = (own[0]["y"], share(whole, [r for r in own if not r["fold"]]), share(rest, own))
    return out


def laid_out(forest: list, depth: int = DEPTH) -> tuple[list[list[int]], list[list[float]], list[list[float]]]:
    """For each tree the features and thresholds of its inner nodes, level by level, and the shares of its leaves.

    The children of node i are 2i + 1 and 2i + 2; a branch that ends early goes on to equal leaves.
    """
    features_, thresholds, leaves = [], [], []
    for tree in forest:
        level, f, t = [tree], [], []
        for _ in range(depth):
            f += [n[0] if isinstance(n, tuple) else 0 for n in level]
            t += [float(n[1]) if isinstance(n, tuple) else 0.0 for n in level]
            level = [c for n in level for c in (n[2:] if isinstance(n, tuple) else (n, n))]
        features_.append(f)
        thresholds.append(t)
        leaves.append([float(n) for n in level])
    return features_, thresholds, leaves


def _list(values: list, kind: str) -> Column:
    return F.array(*map(F.lit, values)).cast(f"array<{kind}>")


def with_votes(df: DataFrame, forest: list, x: str, name: str) -> DataFrame:
    """``df`` with the forest's mean share for the features ``df[x]``; 0.5 without trees.

    Each level is a projection of its own that moves every tree's place one level
    down by array lookups: small enough to be compiled, whatever the forest.
    """
    if not forest:
        return df.withColumn(name, F.lit(0.5))
    own, thresholds, leaves = laid_out(forest)
    out = df.withColumns({f"__at{t}": F.lit(0) for t in range(len(forest))})
    for _ in range(DEPTH):
        places = {t: F.col(f"__at{t}") for t in range(len(forest))}
        out = out.withColumns({f"__at{t}": 2 * at + 1 + (F.get(x, F.get(_list(own[t], "int"), at)) > F.get(_list(thresholds[t], "double"), at)).cast("int") for t, at in places.items()})
    total = F.lit(0.0)
    for t in range(len(forest)):
        total = total + F.get(_list(leaves[t], "double"), F.col(f"__at{t}") - ((1 << DEPTH) - 1))
    return out.withColumn(name, total / len(forest)).drop(*[f"__at{t}" for t in range(len(forest))])


def votes(forest: list, x: Column) -> Column:
    """The same as one expression over an array of features, for use within a list of candidates."""
    if not forest:
        return F.lit(0.5)
    own, thresholds, leaves = (_list([v for tree in part for v in tree], kind) for part, kind in zip(laid_out(forest), ("int", "double", "double"), strict=True))
    inner, ends = (1 << DEPTH) - 1, 1 << DEPTH
    levels = F.array(*map(F.lit, range(DEPTH)))

    def tree(total: Column, t: Column) -> Column:
        end = F.aggregate(levels, F.lit(0), lambda at, _: 2 * at + 1 + (F.get(x, F.get(own, t * inner + at)) > F.get(thresholds, t * inner + at)).cast("int"))
        return total + F.get(leaves, t * ends + end - inner)

    return F.aggregate(F.array(*map(F.lit, range(len(forest)))), F.lit(0.0), tree) / len(forest)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``(id, start, secret, left, right, path)`` of every candidate; ``start`` counts characters from 0.

    The text is split at the candidates once; pieces and candidates alternate,
    so a running sum of their lengths gives the places without another search.
    """
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), (F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")).alias("path"))
    # a search first: most texts have no candidate, and only those that do are numbered and split
    some = rows.filter(F.col("text").rlike(f"[0-9]|[=:]|{PREFIX}|-----BEGIN") & F.col("text").rlike(PATTERN)).withColumn("row", F.monotonically_increasing_id())
    cut = some.select("id", "row", "path", F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("found"), F.split("text", PATTERN, -1).alias("pieces"))
    one = F.posexplode(F.transform("found", lambda s, i: F.struct(s.alias("secret"), F.right(F.element_at("pieces", i + 1), F.lit(CONTEXT)).alias("left"), F.left(F.element_at("pieces", i + 2), F.lit(CONTEXT)).alias("right"), F.length(F.element_at("pieces", i + 1)).alias("before"))))
    out = cut.select("id", "row", "path", one.alias("at", "c"))
    from pyspark.sql import Window

    w = Window.partitionBy("row").orderBy("at")
    start = F.sum(F.col("c.before") + F.length("c.secret")).over(w) - F.length("c.secret")
    return out.select("id", start.alias("start"), "c.secret", "c.left", "c.right", "path")


def scan(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", cut: float = CUT) -> DataFrame:
    """``(id, start, length, secret, score, is_secret)`` of every candidate of every whole text.

    ``findings`` are labelled ones to learn from; without them those made by
    rule serve. Null and empty texts have no candidates; a null path counts as
    empty; repeated rows give their candidates again; other columns are ignored.
    """
    forest = fit(findings if findings is not None else labelled_findings(docs.sparkSession))
    found = candidates(docs, id_col, text_col, path_col)
    named = found.withColumn("x", F.array(*features(*map(F.col, ("secret", "left", "right", "path")))))
    # out of a list of one: a caller's filter on the score stays here, and is not spelled out over all levels of all trees
    scored = with_votes(named, forest, "x", "votes").withColumn("score", F.explode(F.array(F.round("votes", 6))))
    return scored.select(F.col("id").alias(id_col), "start", F.length("secret").alias("length"), "secret", "score", (F.col("score") >= cut).alias("is_secret"))


def redact(docs: DataFrame, findings: DataFrame | None = None, text_col: str = "text", path_col: str | None = "source", cut: float = CUT, mark: str = "[SECRET]", size_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns, every secret in the text replaced by ``mark``; ``size_col`` is counted anew.

    Each text is put together from its pieces in place: no shuffle, no join. Null
    and empty texts stay as they are, a null path counts as empty, repeated rows
    are changed alike; a tie at the cut is a secret.
    """
    forest = fit(findings if findings is not None else labelled_findings(docs.sparkSession))
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    found, pieces = F.regexp_extract_all(F.col(text_col), F.lit(PATTERN), F.lit(0)), F.split(F.col(text_col), PATTERN, -1)
    work = docs.withColumn("__cut", F.when(F.col(text_col).rlike(PATTERN), F.struct(found.alias("found"), pieces.alias("pieces"))))

    def part(s: Column, i: Column) -> Column:
        left, right = F.element_at("__cut.pieces", i + 1), F.element_at("__cut.pieces", i + 2)
        # the features are bound once: a lambda over a struct keeps the trees' tests short
        x = F.array(*features(s, F.right(left, F.lit(CONTEXT)), F.left(right, F.lit(CONTEXT)), path))
        return F.concat(left, F.element_at(F.transform(F.array(x), lambda v: F.when(F.round(votes(forest, v), 6) >= cut, F.lit(mark)).otherwise(s)), 1))

    joined = F.concat(F.array_join(F.transform("__cut.found", part), ""), F.element_at("__cut.pieces", -1))
    new = F.when(F.col("__cut").isNotNull(), joined).otherwise(F.col(text_col))
    out = work.withColumn(text_col, new).drop("__cut")
    if size_col and size_col in docs.columns:
        kind = docs.schema[size_col].dataType
        out = out.withColumn(size_col, F.length(text_col).cast(kind))
    return out.select(*docs.columns)
