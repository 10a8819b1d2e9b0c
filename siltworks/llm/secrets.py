"""Secret scans: candidates by shape, false positives removed by a random forest.

Candidates are assignments to names with a part such as ``token``, values that a
sentence names ("the password is ..."), passwords in URLs, keys with known
prefixes, whole private key blocks and long strings. A random forest over length,
character transitions, dictionary coverage, path and neighbouring words, fitted on
labelled findings, tells secrets from hashes, numbers, paths, public keys and
placeholders. The dictionary is counted over all documents. The forest is Spark's own; its nodes become constant arrays that SQL
functions walk inside each row, so a text is searched, judged and cut in one pass
without a join or a shuffle. DataFrame and SQL functions only.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names that a secret is assigned to, words beside secrets, words beside other strings (fixed values).
NAMES = "password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret|auth[_-]?key|credential"
NEAR_SECRET = "password|passwd|passphrase|secret|token|key|bearer|authorization|credential|auth|login"
NEAR_OTHER = "commit|sha|sha1|sha256|md5|hash|checksum|digest|uuid|guid|isbn|issn|order|invoice|version|build|phone|tel|card|iban|account|revision|etag|id|image|photo|file|path|see|docs|integrity|base64|ssh|rsa|ed25519|wallet|address|bitcoin|btc|coin|public|fingerprint|data"
#: Words of placeholders, which also count where they are run together (fixed values).
WORDS = "example|sample|placeholder|changeme|change|your|here|dummy|test|foo|bar|the|and|for|with|name|user|page|index|image|photo|file|docs|data|http|html|www|com|org|net|token|secret|password|key|value|none|null|true|false|xxx+"
#: Prefixes of keys of known kinds (fixed values).
PREFIX = r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}|AIza[0-9A-Za-z_-]{35}|github_pat_[A-Za-z0-9_]{22,}|npm_[A-Za-z0-9]{36}|pypi-[A-Za-z0-9_-]{16,}|hf_[A-Za-z0-9]{30,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}|https://hooks\.slack\.com/services/[A-Za-z0-9/]{20,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]*)?"
#: How public values start that look like keys: digests with their kind, SSH public keys, PNG, GIF and JPEG images, coin addresses (fixed values).
PUBLIC = r"sha(?:1|256|384|512)-|AAAA[BCE][123]|iVBORw0KGgo|R0lGOD|/9j/|bc1[a-z0-9]{20,}$|0x[0-9a-fA-F]{40}$|[13][1-9A-HJ-NP-Za-km-z]{25,33}$"
HEADER = r"-----BEGIN [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
#: A private key up to its end line, or without one its header and the lines of base64 that follow.
PEM = (
    rf"{HEADER}(?:(?:[A-Za-z0-9+/=\s:,.\\\"'_()@]|-(?!-))*+-----END [A-Z0-9 ]{{0,30}}PRIVATE KEY(?: BLOCK)?-----"
    r"|(?:\s{0,4}(?:Proc-Type|DEK-Info|Version|Comment): [^\n]{0,200})*+(?:(?:\\[nr]|\s){0,8}[A-Za-z0-9+/=]{16,})*+(?:(?:\\[nr]|\s){1,8}[A-Za-z0-9+/]++={0,2}\s*+\z)?)"
)
#: A whole name with one of NAMES in it, its sign, an opening quote.
ASSIGNED = rf"(?<![A-Za-z0-9+/_.-])(?=[A-Za-z0-9+/_.-]++[\"']?[ \t]*+[:=])(?i:(?=[a-z0-9+/_.-]*?(?:{NAMES})))[A-Za-z0-9+/_.-]++[\"']?[ \t]*+(?::=|=>|={{1,3}}|:)[ \t]*+[\"']?"
#: A value up to its closing quote; without one up to a space, a quote, a tag, or a comma or semicolon that ends it or has another assignment behind it.
VALUE = (
    r"(?:(?<=\")(?:[^\"\\\r\n]|\\.)++(?=\")|(?<=')(?:[^'\\\r\n]|\\.)++(?=')"
    r"|[^\s\"']+?(?=[,;]{0,3}(?:[\s\"']|</?[A-Za-z][A-Za-z0-9]{0,15}[ ]?/?>|\z)|[,;][A-Za-z_][A-Za-z0-9_.-]{0,63}[ \t]*+[:=]))"
)
#: A word for a secret in a sentence and what leads to its value, which has six characters or more, not letters alone.
SAID = (
    r"(?<![A-Za-z0-9+/_.-])(?i:password|passwd|passphrase|passcode|pwd|secret|token|credential|api key|access key|secret key|private key|bearer|basic)"
    r"(?:[ \t]++(?i:is|was|are|now|set to|changed to|reset to|equals)){0,2}:?[ \t]++[\"'`(]?(?=[^\s\"'`]{0,200}?[0-9!#$%&*+=?@^~])(?=[^\s\"'`]{6})"
)
#: The part of a URL before its password, and the password up to the host.
IN_URL, PASSWORD = r"(?<![A-Za-z0-9+/_.-])[A-Za-z][A-Za-z0-9+.-]*+://[^\s/:@\"'<>]*+:", r"[^\s/@\"'<>]++(?=@)"
LEAD = rf"(?:{ASSIGNED}|{IN_URL}|{SAID})"
CANDIDATE = rf"{PEM}|\b(?:{PREFIX})|{ASSIGNED}{VALUE}|{IN_URL}{PASSWORD}|{SAID}[^\s\"'`]+?(?=[.,;:!?)]*+(?:[\s\"'`]|\z))|(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/_.-]{{16,}}+={{0,2}}"
#: Characters of text before and after a candidate that its neighbouring words are taken from.
BEFORE, AFTER = 40, 24
#: A dictionary word stands in this share of the documents, and in this many.
SHARE, LEAST = 0.01, 20
#: Labelled findings of each kind, trees of the forest, their depth.
PER_KIND, TREES, DEPTH, SEED = 60, 24, 6, 7

#: Parts of the long words among the labelled findings (fixed values).
SYLLABLES = ("ung", "keit", "ver", "schaft", "er", "tion", "ment", "con", "ich", "able", "the", "aire", "ando", "dad", "sch", "be")

FEATURES = ["length", "transitions", "digits", "uppers", "hex", "coverage", "path", "assigned", "prefixed", "near_secret", "near_other", "distinct", "symbols", "spaces", "lower", "words", "public"]


def dictionary(docs: DataFrame, text_col: str = "text") -> list[str]:
    """The words of three letters or more that SHARE of the documents have, and LEAST documents at least, in order.

    Counted over whole texts of all documents. There are at most 1 / SHARE times as
    many as a document has different words on average, so the driver can hold them.
    Letters beside digits or signs of keys and names are not words.
    """
    whole = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"(?<![\p{L}\p{N}_/+=.@-])\p{L}{3,}+(?![\p{N}_/+=@-])"), F.lit(0))
    words = docs.select(F.explode(F.array_distinct(whole)).alias("word")).groupBy("word").count()
    least = max(LEAST, math.ceil(SHARE * docs.count()))
    return sorted(r.word for r in words.where(F.col("count") >= least).select("word").collect())


def known_letters(values: str, words: Sequence[str]) -> Column:
    """How many letters of each of the array column ``values`` are in words of the dictionary, camel case taken apart."""
    if not words:
        return F.expr(f"transform({values}, m -> 0)")
    # written as SQL, which the parser reads at once; a literal made for each word would take seconds
    listed = ",".join(f"'{w}'" for w in words)
    part = r"[\\p{Lu}]?[\\p{Ll}]{2,}|[\\p{Lu}]{3,}"
    return F.expr(f"transform({values}, m -> aggregate(filter(regexp_extract_all(m, '{part}', 0), p -> lower(p) in ({listed})), 0, (n, p) -> n + length(p)))")


def describe(before: Column, match: Column, after: Column, known: Column) -> Column:
    """A candidate's value and features as a struct (value, assigned, prefixed, x); ``known`` counts its letters in dictionary words."""
    name = F.regexp_extract(match, f"^{LEAD}", 0)
    v = F.substr(match, F.length(name) + 1)

    def of_value(v: Column, assigned: Column) -> Column:
        n = F.greatest(F.length(v), F.lit(1)).cast("double")
        share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
        near = lambda words: F.lower(F.concat_ws(" ", before, after)).rlike(rf"(?:^|[^a-z0-9])(?:{words})(?:[^a-z0-9]|$)")
        prefixed = v.rlike(f"^(?:(?:{PREFIX})$|{HEADER})")
        features = {
            "length": n,
            "transitions": share("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]"),
            "digits": share("[0-9]"),
            "uppers": share("[A-Z]"),
            "hex": v.rlike("^[0-9a-f]+$|^[0-9A-F]+$"),
            "coverage": F.lit(1.0) - F.length(F.regexp_replace(v, f"(?i:{WORDS})", "")) / n,
            "path": F.regexp_count(v, F.lit("[/.]")) + F.coalesce(before.rlike(r"://\S*$").cast("double"), F.lit(0.0)) * 4,
            "assigned": assigned,
            "prefixed": prefixed,
            "near_secret": near(NEAR_SECRET),
            "near_other": near(NEAR_OTHER),
            "distinct": F.size(F.array_distinct(F.split(v, ""))) / F.least(n, F.lit(64.0)),
            "symbols": share("[^A-Za-z0-9\\s]"),
            "spaces": share(r"\s"),
            "lower": v.rlike(r"^\p{L}?\p{Ll}*[.,!?:]*$"),
            "words": F.least(known / n, F.lit(1.0)),
            "public": v.rlike(f"^(?:{PUBLIC})"),
        }
        return F.struct(v.alias("value"), assigned.alias("assigned"), prefixed.alias("prefixed"), F.array(*(features[f].cast("double") for f in FEATURES)).alias("x"))

    # a lambda's argument is taken once, however often the features name it
    return F.transform(F.array(F.struct(v.alias("v"), (name != "").alias("a"))), lambda c: of_value(c["v"], c["a"]))[0]


@dataclass
class Forest:
    """Trees as complete binary trees of one depth, one after the other: node n's children are 2n + 1 and 2n + 2."""

    trees: int
    depth: int
    feature: list[int]
    threshold: list[float]
    probability: list[float]
    words: Sequence[str] = ()

    def score(self, x: Column) -> Column:
        """The mean probability of the leaves that an array of features reaches."""
        size = (2 << self.depth) - 1
        constant = lambda values, kind: F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")
        feature, threshold, probability = constant(self.feature, "int"), constant(self.threshold, "double"), constant(self.probability, "double")

        def leaf(tree: Column) -> Column:
            step = lambda n, _: n * 2 + 1 + (F.get(x, F.get(feature, tree * size + n)) > F.get(threshold, tree * size + n)).cast("int")
            return F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), F.lit(0), step)

        return F.aggregate(F.sequence(F.lit(0), F.lit(self.trees - 1)), F.lit(0.0), lambda total, t: total + F.get(probability, t * size + leaf(t)) / self.trees)


def labelled_findings(spark: SparkSession, words: Sequence[str] = ()) -> DataFrame:
    """Labelled findings (before, match, after, label), made by rule: real shapes with random values.

    A bounded sample: PER_KIND of each kind. ``words`` are the dictionary that readable names are made from.
    """
    shown = list(words[:: max(len(words) // 64, 1)]) or ["example", "sample", "index", "image", "user", "page", "value", "your"]
    h = lambda salt: F.sha2(F.concat_ws("-", F.lit(salt), F.col("id")), 256)
    letters = lambda salt: F.regexp_replace(F.base64(F.unhex(h(salt))), "[+/=]", "x")
    upper = lambda salt: F.upper(F.translate(h(salt), "0123456789abcdef", "QW2RT4YUP6SDFGHJ"))
    digits = lambda salt: F.regexp_replace(F.conv(F.substr(h(salt), F.lit(1), F.lit(14)), 16, 10), "^", "4")
    cut = lambda c, n: F.substr(c, F.lit(1), F.lit(n))
    text = lambda *c: F.concat(*(F.lit(x) if isinstance(x, str) else x for x in c))
    small = lambda salt: F.translate(h(salt), "0123456789", "ghijklmnop")
    pick = lambda *words: F.element_at(F.array(*map(F.lit, words)), (F.col("id") % len(words) + 1).cast("int"))
    long_word = lambda salt: F.concat_ws("", *(F.element_at(F.array(*map(F.lit, SYLLABLES)), (F.conv(F.substr(h(salt), F.lit(k), F.lit(4)), 16, 10).cast("int") % len(SYLLABLES) + 1)) for k in range(1, 30, 5)))
    kinds: list[tuple[Column | str, Column, Column | str, int]] = [
        ("and in the ", text('token = "', cut(h("a"), 40)), '" of it', 1),
        ("set the ", text("password=", cut(h("b"), 18)), " then go", 1),
        ("there was ", text("password: ", cut(letters("c"), 12)), " in it", 1),
        ("it has ", text("AKIA", cut(upper("d"), 16)), " as one", 1),
        ("use ", text("ghp_", cut(letters("e"), 36)), " for that", 1),
        ("with ", text("api_key='", cut(letters("f"), 32)), "' and", 1),
        ("as ", text("secret: ", cut(h("g"), 32)), " was", 1),
        ("Authorization: Bearer ", text("eyJ", cut(letters("h"), 20), ".", cut(letters("i"), 30), ".", cut(letters("j"), 20)), " sent", 1),
        ("aws secret key ", text(cut(letters("k"), 40)), " leaked", 1),
        ("his key is ", text(cut(letters("l"), 24), cut(h("l"), 8)), " there", 1),
        ("", F.lit("-----BEGIN RSA PRIVATE KEY-----"), "", 1),
        ("", text("-----BEGIN PRIVATE KEY-----\n", letters("2"), "\n", letters("3"), "\n", letters("4"), "\n-----END PRIVATE KEY-----"), "", 1),
        ("set ", text("DB_PASSWORD=", pick("hunter", "dragon", "s3cr3t", "tr0ub", "passw0", "monk3y"), cut(h("5"), 2), pick("x", "dor", "value")), " then", 1),
        ("export ", text("MY_SECRET=", cut(h("6"), 4), cut(small("6"), 5)), "\n", 1),
        ("with ", text("access_token: ", cut(small("7"), 16)), " and", 1),
        ("", text("aws_secret_access_key = ", F.translate(cut(letters("8"), 32), "0123456789", "gHiJkLmNoP")), "\n", 1),
        ("his key is ", F.translate(cut(letters("9"), 40), "0123456789", "gHiJkLmNoP"), " there", 1),
        ("set ", text("password=", cut(small("10"), 2), pick(",", ";", "<", "!", "$"), cut(small("11"), 9)), " then", 1),
        ("set ", text('password="', cut(small("12"), 4), " ", cut(h("12"), 6), pick("!", ",", "#", ";"), " ", cut(small("13"), 4)), '"', 1),
        (pick("{", "db: {", "settings ", ""), text(pick("'password': '", "'db_password': '", "\"secret\": \"", "passphrase: '"), cut(small("46"), 2), " ", cut(h("46"), 5), pick(", ", "; ", " & ", ". "), cut(small("47"), 4), pick("<", "!", ";", "?"), cut(h("48"), 4)), pick("' y", "'}", "\",", "'\n"), 1),
        ("the ", text(pick("npm_", "glpat-", "ghs_", "sk-", "pypi-"), cut(small("49"), 36)), " of", 1),
        ("", text(pick("postgres://admin:", "https://user:", "mysql://root:", "amqp://svc:"), pick("Hunter", "s3cr", "Dragon", "kx"), cut(letters("30"), 5)), "@db.host", 1),
        ("my ", text(pick("password is ", "password: ", "passcode is now ", "token was ", "secret key is: "), pick("hunter", "dragon", "blue", "k"), cut(h("31"), 3), pick("andmore", "x", "sun", "!")), " so", 1),
        (pick("my ", "his ", "the ", ""), text(pick("password is ", "passphrase is ", "password ", "pwd: "), pick("tiger", "summer", "coffee", "lucky", "silver"), cut(digits("50"), 1), pick("forever", "house", "andyou", "blue", "forme"), pick("", "!", "7")), pick(".", " so", ", ok", "\n"), 1),
        ("login with ", text(pick("password ", "passphrase ", "token "), cut(letters("32"), 8), pick("7", "!", "3", "#")), " there", 1),
        ("Authorization: ", text(pick("Bearer ", "Basic ", "token "), cut(letters("33"), 30), "="), "\n", 1),
        ("use ", text(pick("npm_", "github_pat_", "hf_", "sk_live_"), cut(letters("34"), 36)), " for that", 1),
        ("post to ", text("https://hooks.slack.com/services/T", cut(upper("35"), 8), "/B", cut(upper("36"), 8), "/", cut(letters("37"), 24)), " now", 1),
        ("the ", text(pick("token ", "password ", "secret "), pick("3-gram", "reset-link", "section-2", "length=8", "count=256", "50% of", "(8+ characters)", "A/B-test")), " of", 0),
        ("a ", text(pick("password is ", "token is ", "secret was "), pick("required!", "missing?", "8-16", "optional=true", "50+ long", "case-sensitive*")), " in", 0),
        ("", text(pick("http://localhost:", "https://user:", "redis://app:"), pick("password", "${PASS}", "<password>", "********")), "@host", 0),
        (pick("integrity ", "resolved, ", "has "), text("sha512-", letters("38"), letters("39"), "=="), " in", 0),
        ("ssh-rsa ", text("AAAAB3NzaC1yc2EAAAADAQABAAABAQ", letters("40"), letters("41")), " me@host", 0),
        (pick("data:image/png;base64,", "image: ", "src="), text(pick("iVBORw0KGgo", "R0lGOD", "/9j/"), letters("42"), letters("43")), " alt", 0),
        (pick("send to ", "wallet ", "coin address "), text(pick("bc1q", "0x", "1"), cut(h("44"), 40)), " now", 0),
        ("in ", F.concat_ws("_", pick(*shown), pick(*shown[3:], *shown[:3]), pick(*shown[5:], *shown[:5]), cut(digits("45"), 2)), " is", 0),
        ("at ", F.concat(pick(*shown), F.initcap(pick(*shown[2:], *shown[:2])), F.initcap(pick(*shown[7:], *shown[:7])), F.lit("Factory")), "(", 0),
        ("has ", long_word("14"), " in it", 0),
        ("", F.initcap(long_word("15")), ". the", 0),
        ("the ", F.upper(long_word("23")), " of", 0),
        ("of ", text(long_word("16"), "-", long_word("17")), " as", 0),
        ("in ", text("src/", long_word("18"), "/", long_word("19"), ".java"), " is", 0),
        ("", F.repeat(pick("-", "_", ".", "/", "=-", "+"), (F.col("id") % 40 + 16).cast("int")), "\n", 0),
        ("the ", text(pick("token", "password", "secret", "secretary", "tokenizer", "max_tokens"), ": ", pick("a", "is", "none", "true", "required", "yes", "it", "256", "no.", "the", "null", "1", "Maria", "Smith", "Then", "John")), " of", 0),
        ("x ", text("password = ", pick("${DB_PASSWORD}", "os.environ[", "get_password()", "<password>", "getpass.getpass()", "********")), "", 0),
        ("his ", text('secret: "', long_word("20"), " the ", long_word("21"), " and for with ", long_word("22")), '" said', 0),
        ("fixed in commit ", cut(h("m"), 40), " of main", 0),
        ("sha256 of it: ", h("n"), " ok", 0),
        ("md5 checksum ", cut(h("o"), 32), " fits", 0),
        ("the and of ", cut(digits("p"), 16), " in the", 0),
        ("card number ", cut(digits("q"), 16), " was", 0),
        ("is a the ", text(cut(h("r"), 8), "-", F.substr(h("r"), F.lit(9), F.lit(4)), "-4", F.substr(h("r"), F.lit(13), F.lit(3)), "-a", F.substr(h("r"), F.lit(16), F.lit(3)), "-", F.substr(h("r"), F.lit(20), F.lit(12))), " row", 0),
        ("see ", text("assets/images/photo-", cut(digits("s"), 9), ".html"), " for it", 0),
        ("see https://www.example.com/", text("docs/page/", cut(digits("t"), 8), "/index.html"), " now", 0),
        ("set ", text("password=", F.element_at(F.array(*map(F.lit, ("changeme", "example", "your-password-here", "xxxxxxxx"))), (F.col("id") % 4 + 1).cast("int"))), " first", 0),
        ("set ", text('token = "your-token-here', cut(digits("u"), 1)), '" there', 0),
        ("the release ", text("example-data-test-page-", cut(digits("v"), 4)), " is", 0),
        ("build version ", text(cut(digits("w"), 2), ".", cut(digits("x"), 2), ".", cut(digits("y"), 12)), " out", 0),
        ("in the of ", cut(h("z"), 40), " the and", 0),
        ("mail ", text("user.name.", cut(digits("1"), 3), "-mail.example.com"), " sent", 0),
    ]
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    kind = lambda b, m, a, y: F.struct(as_column(b).alias("before"), m.alias("match"), as_column(a).alias("after"), F.lit(float(y)).alias("label"))
    # a few kinds at a time: one array of all of them is more code than the JVM compiles
    ids = spark.range(0, PER_KIND, 1, 1)
    return reduce(DataFrame.unionByName, (ids.select(F.inline(F.array(*(kind(*k) for k in kinds[i : i + 6])))) for i in range(0, len(kinds), 6)))


def fit(findings: DataFrame, words: Sequence[str] = ()) -> Forest:
    """A random forest over labelled findings (before, match, after, label), with the dictionary to be used."""
    one = findings.coalesce(1).withColumn("matches", F.array("match")).withColumn("known", F.get(known_letters("matches", words), F.lit(0)))
    x = describe(F.col("before"), F.col("match"), F.col("after"), F.col("known"))["x"]
    rows = one.select("label", x.alias("x")).select("label", *(F.get("x", i).alias(f) for i, f in enumerate(FEATURES)))
    rows = rows.persist()  # read by each pass of the fit
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features").fit(vectors.select("features", "label"))
    rows.unpersist()
    size = (2 << DEPTH) - 1
    out = Forest(TREES, DEPTH, [0] * TREES * size, [0.0] * TREES * size, [0.0] * TREES * size, words)

    def fill(node, base: int, n: int) -> None:
        """Node ``n`` and all below it; a leaf above the last level passes its probability down."""
        out.probability[base + n] = node.impurityStats().prob(1.0)
        if 2 * n + 2 < size:
            inner = node.subtreeDepth() > 0
            if inner:
                out.feature[base + n], out.threshold[base + n] = node.split().featureIndex(), node.split().threshold()
            fill(node.leftChild() if inner else node, base, 2 * n + 1)
            fill(node.rightChild() if inner else node, base, 2 * n + 2)

    for k, tree in enumerate(model.trees):
        fill(tree._java_obj.rootNode(), k * size, 0)
    return out


def fitted(docs: DataFrame, text_col: str = "text") -> Forest:
    """A forest over labelled findings with the dictionary of ``docs``."""
    words = dictionary(docs, text_col)
    return fit(labelled_findings(docs.sparkSession, words), words)


def searched(docs: DataFrame, text_col: str, forest: Forest) -> DataFrame:
    """``docs`` with columns __between (what stands between candidates) and __found (match, value, assigned, prefixed, probability); both null without a candidate."""
    cut = docs.withColumn("__matches", F.regexp_extract_all(F.col(text_col), F.lit(CANDIDATE), F.lit(0)))
    some = F.size("__matches") > 0
    cut = cut.withColumn("__known", known_letters("__matches", forest.words))
    cut = cut.withColumn("__between", F.when(some, F.split(F.col(text_col), CANDIDATE, -1)))
    before = lambda i: F.right(F.get("__between", i), F.lit(BEFORE))
    after = lambda i: F.left(F.get("__between", i + 1), F.lit(AFTER))
    described = F.transform("__matches", lambda m, i: F.struct(m.alias("match"), describe(before(i), m, after(i), F.get("__known", i)).alias("d")))
    cut = cut.withColumn("__found", F.when(some, described)).drop("__matches", "__known")
    scored = lambda c: F.struct(c["match"].alias("match"), c["d"]["value"].alias("value"), c["d"]["assigned"].alias("assigned"), c["d"]["prefixed"].alias("prefixed"), forest.score(c["d"]["x"]).alias("probability"))
    return cut.withColumn("__found", F.transform("__found", scored))


def running_sums(values: Column) -> Column:
    """The sum of the values before each value; by blocks, so a long array does not cost its square."""
    size = 256
    n = F.size(values)
    add = lambda a, b: a + b
    block_sums = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int")), lambda b: F.aggregate(F.slice(values, b * size + 1, size), F.lit(0).cast("long"), add))
    before = F.aggregate(block_sums, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("all")), lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")))["all"]
    inside = lambda i: F.aggregate(F.slice(values, F.floor(i / size).cast("int") * size + 1, i % size), F.lit(0).cast("long"), add)
    # a lambda's argument is taken once: as part of the inner lambda the block sums would be added up for each value
    return F.get(F.transform(F.array(before), lambda at: F.transform(values, lambda _, i: F.get(at, F.floor(i / size).cast("int")) + inside(i))), F.lit(0))


def findings(docs: DataFrame, model: Forest | None = None, id_col: str = "doc_id", text_col: str = "text", with_value: bool = False) -> DataFrame:
    """Rows (doc_id, start, length, kind, probability, is_secret) for each candidate in ``docs``.

    ``start`` counts characters before the candidate's value; is_secret is the
    forest's decision. Texts are searched whole. A null or empty text has no
    findings; repeated rows have their findings each; a null id keeps its
    findings; other columns are not read. ``with_value`` adds the value itself.
    """
    model = model or fitted(docs, text_col)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = searched(source, "text", model)
    lengths = F.transform("__found", lambda c, i: (F.length(F.get("__between", i)) + F.length(c["match"])).cast("long"))
    found = found.select("doc_id", "__found", "__between", lengths.alias("lengths")).select("doc_id", "__found", "__between", running_sums(F.col("lengths")).alias("starts"))
    # no filter on the arrays, which would search each text again
    each = found.select("doc_id", "__between", "starts", F.posexplode_outer("__found").alias("i", "c")).where("c is not null")
    length = F.length("c.value")
    start = F.get("starts", F.col("i")) + F.length(F.get("__between", F.col("i"))) + F.length("c.match") - length
    kind = F.when(F.col("c.match").rlike(f"^{HEADER}"), "private key").when(F.col("c.prefixed"), "known key").when(F.col("c.assigned"), "assigned").otherwise("string")
    out = [
        "doc_id", start.cast("long").alias("start"), length.cast("long").alias("length"), kind.alias("kind"), F.round("c.probability", 6).alias("probability"), (F.col("c.probability") > 0.5).alias("is_secret"),
    ]
    return each.select(*out, *([F.col("c.value").alias("value")] if with_value else []))


def redact(docs: DataFrame, mark: str = "[SECRET]", text_col: str = "text", model: Forest | None = None) -> DataFrame:
    """``docs`` with the secrets of its texts replaced and n_chars counted anew.

    Secrets are cut where they stand, in the row they stand in, so rows without an
    id and repeated rows are treated like others, and an equal string that is part
    of another word stays. Rows keep all their columns; null texts and those
    without a secret stay as they are.
    """
    forest = model or fitted(docs, text_col)
    # columns of the same names stand aside meanwhile
    aside = {c: f"{c}_{uuid.uuid4().hex}" for c in ("__found", "__between", "__matches", "__known") if c in docs.columns}
    whole = searched(docs.withColumnsRenamed(aside), text_col, forest)
    name = lambda c: F.left(c["match"], F.length(c["match"]) - F.length(c["value"]))
    put = F.transform("__found", lambda c, i: F.concat(F.get("__between", i), F.when(c["probability"] > 0.5, F.concat(name(c), F.lit(mark))).otherwise(c["match"])))
    clean = F.concat(F.array_join(put, ""), F.element_at("__between", -1))
    whole = whole.withColumn(text_col, F.when(F.exists("__found", lambda c: c["probability"] > 0.5), clean).otherwise(F.col(text_col)))
    if "n_chars" in docs.columns:
        whole = whole.withColumn("n_chars", F.length(text_col).cast("long"))
    return whole.select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))
