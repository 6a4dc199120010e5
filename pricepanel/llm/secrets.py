"""Secret scan with a random forest that removes false positives.

Candidates are stretches that could be a key, token or password: twelve or more characters
of an encoding alphabet with a letter and a digit among them; values of any length and
characters assigned to a name like ``password``, with or without quotes and white space
around the sign; runs of ``LETTERS`` or more letters; and the password of a URL
(``scheme://user:password@host``). Each is
described by its length, the changes of character class along it, the part of it that
dictionary words cover, its path, and the words around it. A random forest trained on
labelled findings gives the probability that a candidate is a secret.

A quoted value that is assigned is one candidate up to its closing quote, if that stands on
the same line; spaces and tabs in it are shown as spaces, and it counts as one word in
``place``. Any other value ends at white space. Values that are neither assigned nor in a URL
are candidates only if they are as long as said. Of letters-only runs without a telling
word nearby the forest takes those of mixed case only: others may be long words.

The forest is trained by Spark ML on at most ``MAX_FINDINGS`` labelled findings, the first by
a hash, and then written out as one SQL expression, so scanning is built-in expressions only.
Texts are not shuffled; a text without a candidate is passed over by one pattern.

The default labelled findings are made by a rule: keys of common forms in fitting
surroundings, and lookalikes such as identifiers, checksums, paths and placeholders.

Edge cases: null and empty texts have no candidates. A null path says nothing. Repeated rows
are scanned one by one, and a value that stands in a text twice is found twice. Without
documents the result is empty. Other columns are not touched.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.llm.common import let, words_of

MAX_FINDINGS = 20_000
TREES = 20
DEPTH = 8
SEED = 17
THRESHOLD = 0.5
# Letters that a letters-only run needs.
LETTERS = 24

_RUN = "[A-Za-z0-9+/_-]"
# A run with a letter and a digit; only its first position is tried.
_ENCODED = (
    f"(?<!{_RUN})(?:(?={_RUN}*[0-9])(?={_RUN}*[A-Za-z]){_RUN}{{12,}}={{0,2}}"
    f"|[A-Za-z]{{{LETTERS},}}+(?!{_RUN})={{0,2}})"
)
_NAMES = "pass|password|passwd|pwd|secret|token|api_key|apikey|key"
_ASSIGN = f"(?:{_NAMES})[\"']?\\]?\\s*+[=:]{{1,3}}+>?+\\s*+(?:[\"'](?=[^\\s\"'])|(?=[^\\s\"',;]))"
_LOGIN = "://[^\\s/:@]*+:(?=[^\\s/]+@)"
_IN_TEXT = f"(?i){_ASSIGN}|{_LOGIN}|{_ENCODED}"
# Put before an assigned value, before a URL's password and in place of a space in a quoted
# value; Unicode keeps all of them out of texts.
_MARK, _URL_MARK, _SPACE = "\ufdd0", "\ufdd1", "\ufdd2"
_IN_WORD = (
    f"(?i)(?<={_URL_MARK})[^\\s/]+(?=@)"
    # A URL with a password is not a value itself.
    f"|(?<={_MARK})(?![^\\s\"',;]*{_URL_MARK})"
    f"(?:(?<=\"{_MARK})[^\\s\"]+|(?<='{_MARK})[^\\s']+|(?<![\"']{_MARK})[^\\s\"',;]+)"
    f"|{_ENCODED}"
)

# Words that speak for or against a secret nearby, paths that hold examples.
_FOR = "pass|pwd|secret|token|key|auth|credential|bearer|private|login"
_AGAINST = "commit|sha1|sha256|md5|checksum|digest|uuid|version|build|example|sample|dummy|path|page"
_PASSWORDS = "password|passwd|pwd|secret"
# Whole components of a path.
_EXAMPLE_PATH = "(?:^|[/\\\\])(?:tests?|examples?|samples?|mocks?|fixtures?|doc)(?:$|[/\\\\])"
# Dictionary words that identifiers, paths and placeholders are made of.
DICTIONARY = (
    "about", "account", "action", "address", "admin", "after", "array", "async", "backup", "base",
    "before", "build", "cache", "change", "chapter", "check", "class", "client", "code", "column",
    "commit", "common", "config", "content", "count", "create", "data", "date", "debug", "default",
    "delete", "demo", "digest", "dist", "document", "download", "dummy", "error", "event", "example",
    "fail", "field", "file", "filter", "final", "first", "from", "function", "group", "header",
    "hello", "here", "home", "http", "image", "import", "index", "info", "input", "insert",
    "install", "internal", "introduction", "item", "javascript", "label", "last", "left", "length",
    "level", "library", "line", "link", "list", "local", "login", "main", "manager", "message",
    "method", "model", "module", "name", "node", "null", "number", "object", "option", "order",
    "output", "package", "packages", "page", "parent", "part", "password", "path", "placeholder",
    "print", "process", "project", "property", "python", "query", "random", "read", "record",
    "release", "report", "request", "response", "result", "return", "right", "root", "sample",
    "script", "search", "section", "select", "server", "service", "session", "settings", "share",
    "source", "stable", "start", "state", "status", "step", "string", "style", "system", "table",
    "target", "template", "test", "text", "time", "title", "token", "type", "update", "upload",
    "user", "value", "version", "view", "with", "word", "world", "write", "your",
)
FEATURES = (
    "length", "transitions", "case_changes", "digit_share", "upper_share", "distinct_share",
    "longest_repeat", "coverage", "example_path", "words_for", "words_against", "assigned",
    "symbol_share", "named", "in_url",
)


def _marked(text: Column) -> Column:
    """A text with a mark before each assigned value and each password of a URL.

    White space inside of quoted values is marked too, so that each stays one word.
    """
    marked = F.translate(text, _MARK + _URL_MARK + _SPACE, "\ufffd" * 3)
    marked = F.regexp_replace(marked, f"(?i){_ASSIGN}", f"$0{_MARK}")
    for quote in "\"'":
        # From a quote that is closed on its line, and then on from the last space.
        start = f"(?<={quote}{_MARK})(?=[^{quote}\\n\\x0B\\f\\r]*+{quote})|(?!^)\\G"
        marked = F.regexp_replace(marked, f"((?:{start})[^\\s{quote}]*+)[ \\t]", f"$1{_SPACE}")
    return F.regexp_replace(marked, f"{_LOGIN}", f"$0{_URL_MARK}")


def _unmarked(text: Column) -> Column:
    return F.translate(text, _SPACE + _MARK + _URL_MARK, " ")


def candidates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source"
) -> DataFrame:
    """doc_id, path, place of the word, candidate and the words around it."""

    def of_words(words: Column) -> Column:
        def of_word(place: Column) -> Column:
            word = F.get(words, place)
            before = F.concat_ws(
                " ", F.get(words, place - 2), F.get(words, place - 1), word
            )
            after = F.coalesce(F.get(words, place + 1), F.lit(""))
            return F.transform(
                F.regexp_extract_all(word, F.lit(_IN_WORD), F.lit(0)),
                lambda found: F.struct(
                    place.alias("place"), _unmarked(found).alias("candidate"),
                    _unmarked(before).alias("before"), _unmarked(after).alias("after"),
                ),
            )

        places = F.array_compact(
            F.transform(words, lambda word, i: F.when(word.rlike(_IN_WORD), i))
        )
        return F.flatten(F.transform(places, of_word))

    with_any = documents.where(F.col(text).rlike(_IN_TEXT))
    found = with_any.select(
        F.col(doc_id).alias("doc_id"),
        F.col(path).cast("string").alias("path"),
        F.explode(let(words_of(_marked(F.col(text))), of_words)).alias("__found"),
    )
    return found.select("doc_id", "path", "__found.*")


def _hits(text: Column, pattern: str) -> Column:
    return F.regexp_count(F.lower(text), F.lit(f"(?:{pattern})"))


def with_features(found: DataFrame) -> DataFrame:
    """Add ``FEATURES`` to candidates with ``candidate``, ``before``, ``after`` and ``path``."""
    value = F.col("candidate")
    n = F.length(value)

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / n

    change = "(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]|(?<=[^a-zA-Z0-9])[a-zA-Z0-9]"
    words = "|".join(sorted(DICTIONARY, key=len, reverse=True))
    uncovered = F.length(F.regexp_replace(F.lower(value), words, ""))
    unrepeated = F.length(F.regexp_replace(value, "(.)\\1{2,}", ""))
    around = F.concat_ws(" ", F.col("before"), F.col("after"))
    # The candidate itself is not one of the words around it.
    around = F.replace(around, value, F.lit(" "))
    # What stands before the candidate's last place in its word.
    rest = F.length(F.call_function("substring_index", F.col("before"), value, F.lit(-1)))
    lead = F.left("before", F.length("before") - rest - n)
    columns = {
        "length": n,
        "transitions": share(change),
        "case_changes": share("(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]"),
        "digit_share": share("[0-9]"),
        "upper_share": share("[A-Z]"),
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / n,
        "longest_repeat": 1 - unrepeated / n,
        "coverage": 1 - uncovered / n,
        "example_path": F.coalesce(F.lower("path").rlike(_EXAMPLE_PATH), F.lit(False)),
        "words_for": _hits(around, _FOR),
        "words_against": _hits(around, _AGAINST),
        "assigned": lead.rlike("[=:]>?[ \"']*$"),
        "symbol_share": share("[^A-Za-z0-9]"),
        "named": lead.rlike(f"(?i)(?:{_PASSWORDS})[\"']?\\]? *[=:]{{1,3}}>? *[\"']?$"),
        "in_url": lead.rlike("://[^ /:@]*:$"),
    }
    return found.withColumns({name: columns[name].cast("double") for name in FEATURES})


def labelled_findings(spark: SparkSession, n: int = 8_000) -> DataFrame:
    """Findings made by a rule, ``label`` 1 for secrets."""
    made = spark.range(n).select(
        "id",
        F.sha2(F.concat(F.lit("finding"), F.col("id").cast("string")), 512).alias("hex"),
        F.array(*map(F.lit, DICTIONARY)).alias("dictionary"),
    )
    made = made.withColumns(
        {
            "key": F.translate(F.base64(F.unhex(F.substring("hex", 1, 96))), "=", ""),
            "upper": F.translate(F.substring("hex", 90, 30), "0189abcdef", "QWERTYUIOP"),
            "word": F.expr("dictionary[conv(substr(hex, 1, 4), 16, 10) % size(dictionary)]"),
            "other": F.expr("dictionary[conv(substr(hex, 5, 4), 16, 10) % size(dictionary)]"),
            "third": F.expr("dictionary[conv(substr(hex, 9, 4), 16, 10) % size(dictionary)]"),
            "number": F.expr("conv(substr(hex, 13, 3), 16, 10)"),
            "letters": F.translate(F.substring("hex", 60, 30), "0123456789", "ghijklmnop"),
            "mixed": F.expr("concat(upper(substr(hex, 70, 1)), translate(substr(hex, 71, 3 + id % 5), "
                            "'0123', 'rstu'), substr('!$%^&*#?', 1 + id % 8, 1), substr(hex, 80, 1 + id % 3))"),
            "cased": F.translate(F.translate(F.base64(F.unhex(F.substring("hex", 1, 96))), "+/=", "xy"),
                                 "0123456789", "KvTqZbWgLs"),
            "named": F.expr("element_at(array('password', 'pwd', 'secret', 'db_password', 'passwd'), "
                            "1 + CAST(conv(substr(hex, 30, 4), 16, 10) % 5 AS INT))"),
            "sign": F.expr("IF(substr(hex, 34, 1) < '8', '=', ':')"),
            "turn": F.expr("conv(substr(hex, 16, 4), 16, 10) % 1000"),
        }
    )
    # (label, 2 for a password that counts as made up in an example; candidate, word two before, word before,
    # own word with {} for the candidate)
    forms = (
        (1, "concat('AKIA', substr(upper, 1, 16))", "word", "other", "{}"),
        (2, "substr(hex, 20, 18)", "word", "other", "password={}"),
        (1, "substr(hex, 20, 40)", "'token'", "'='", "\"{}\""),
        (1, "substr(key, 1, 40)", "word", "'secret_key:'", "{}"),
        (1, "concat('ghp_', substr(translate(key, '+/', 'xy'), 1, 36))", "word", "other", "{}"),
        (1, "substr(translate(key, '+/', 'xy'), 1, 20 + id % 12)", "other", "word", "api_key={}"),
        (2, "mixed", "word", "concat(named, ':')", "{}"),
        (2, "mixed", "named", "sign", "{}"),
        (2, "mixed", "named", "sign", "\"{}\""),
        (2, "mixed", "other", "word", "pwd={}"),
        (2, "concat_ws('-', substr(letters, 1, 4 + id % 4), substr(letters, 9, 5), substr(letters, 15, 7))",
            "named", "sign", "\"{}\""),
        (2, "substr(letters, 1, 7 + id % 14)", "named", "sign", "\"{}\""),
        (2, "substr(letters, 1, 7 + id % 14)", "other", "concat(named, ':')", "{}"),
        (2, "mixed", "word", "other", "postgres://admin:{}@db.host/data"),
        (2, "substr(letters, 1, 6 + id % 14)", "word", "other", "https://user:{}@host/path"),
        (2, "concat_ws(' ', substr(letters, 1, 4 + id % 4), substr(letters, 9, 5), substr(letters, 15, 7))",
            "named", "sign", "\"{}\""),
        (2, "concat_ws(' ', substr(letters, 1, 3 + id % 5), mixed)", "other", "concat(named, ':')", "\"{}\""),
        (1, "substr(cased, 1, 24 + id % 24)", "word", "'Bearer'", "{}"),
        (1, "substr(cased, 1, 24 + id % 24)", "word", "other", "{}"),
        (1, "substr(letters, 1, 24 + id % 7)", "'Authorization:'", "'Bearer'", "{}"),
        (0, "word", "named", "sign", "{}"),
        (0, "concat_ws(' ', 'enter', 'your', named)", "named", "sign", "\"{}\""),
        (0, "concat_ws(' ', word, other, third)", "other", "concat(named, ':')", "\"{}\""),
        (0, "concat_ws(' ', substr(letters, 1, 5), word, substr(letters, 9, 6))", "'key'", "sign", "\"{}\""),
        (0, "concat(word, initcap(other), initcap(third), initcap(word), 'Listener')", "word", "third", "{}"),
        (0, "concat(word, other, third, word, other)", "word", "other", "{}"),
        (0, "substr(letters, 1, 24 + id % 7)", "word", "other", "{}"),
        (0, "repeat(substr(letters, 1, 1 + id % 2), 30)", "word", "other", "{}"),
        (0, "concat(word, other)", "other", "concat(named, ':')", "{}"),
        (0, "concat('$', '{', word, '}')", "named", "sign", "\"{}\""),
        (0, "concat('your_', named)", "named", "sign", "\"{}\""),
        (0, "'********'", "other", "concat(named, ':')", "{}"),
        (0, "concat(word, '.', other, '(', ')')", "named", "sign", "{}"),
        (0, "substr(letters, 1, 1 + id % 12)", "word", "'key:'", "{}"),
        (0, "substr(letters, 1, 5 + id % 8)", "other", "'key:'", "{}"),
        (0, "substr(letters, 1, 5 + id % 8)", "'token'", "sign", "{}"),
        (0, "substr(letters, 1, 5 + id % 8)", "word", "'pass:'", "{}"),
        (0, "number", "'token'", "sign", "{}"),
        (0, "substr(letters, 1, 1 + id % 3)", "named", "sign", "{}"),
        (0, "word", "other", "third", "https://user:{}@host/path"),
        (0, "concat(word, number, '-', other, '-', third)", "word", "third", "{}"),
        (0, "substr(hex, 20, 40)", "word", "'commit'", "{}"),
        (0, "concat_ws('-', substr(hex, 1, 8), substr(hex, 9, 4), substr(hex, 13, 4), "
            "substr(hex, 17, 4), substr(hex, 21, 12))", "'uuid'", "word", "{}"),
        (0, "concat('/', word, '/lib/', other, number, '/', third)", "word", "'path'", "{}"),
        (0, "concat(word, other, number)", "word", "third", "password={}"),
        (0, "concat('xxxxxxxxxxxx', number)", "word", "'token'", "secret:{}"),
        (0, "concat(word, '_', other, '_', number, '_', third)", "other", "'='", "{}"),
        (0, "concat('release-20', lpad(id % 30, 2, '0'), '-', word, number)", "'version'", "other", "{}"),
    )
    pick = F.col("id") % len(forms)
    labels = F.array(*(F.lit(float(label)) for label, *_ in forms))
    values = F.array(*(F.expr(value).cast("string") for _, value, *_ in forms))
    first = F.array(*(F.expr(two) for _, _, two, _, _ in forms))
    second = F.array(*(F.expr(one) for _, _, _, one, _ in forms))
    own = F.array(*(F.lit(form) for *_, form in forms))

    def chosen(options: Column) -> Column:
        return F.get(options, pick.cast("int"))

    path = F.when(F.col("turn") % 7 == 0, F.concat(F.lit("tests/"), "word")).otherwise(F.col("other"))
    made_up = (chosen(labels) == 2) & path.rlike(_EXAMPLE_PATH)
    return made.select(
        chosen(values).alias("candidate"),
        F.concat_ws(
            " ", chosen(first), chosen(second), F.replace(chosen(own), F.lit("{}"), chosen(values))
        ).alias("before"),
        F.col("third").alias("after"),
        path.alias("path"),
        # A key in a test is a key still.
        F.when(made_up, 0.0).otherwise(F.least(chosen(labels), F.lit(1.0))).alias("label"),
    )


def train(findings: DataFrame, max_findings: int = MAX_FINDINGS) -> RandomForestClassificationModel:
    """A forest over at most ``max_findings`` labelled findings, the first by a hash."""
    order = F.xxhash64("candidate", "before", "after", "path")
    bounded = with_features(findings.orderBy(order, "label").limit(max_findings))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        bounded.select(*FEATURES, "label")
    )
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    # One partition of a bounded number of rows, so that bootstrap samples are reproducible.
    return forest.fit(vectors.coalesce(1))


def forest_sql(model: RandomForestClassificationModel) -> str:
    """The forest's probability of a secret as one SQL expression over the features."""

    def of_node(node) -> str:
        if node.subtreeDepth() == 0:
            counts = list(node.impurityStats().stats())
            return f"{counts[1] / sum(counts)!r}D"
        split = node.split()
        name = FEATURES[split.featureIndex()]
        left, right = of_node(node.leftChild()), of_node(node.rightChild())
        return f"IF({name} <= {split.threshold()!r}D, {left}, {right})"

    trees = [of_node(tree._java_obj.rootNode()) for tree in model.trees]
    return f"({' + '.join(trees)}) / {len(trees)}"


def scan(
    documents: DataFrame,
    findings: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str = "source",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per candidate with its probability and verdict."""
    spark = documents.sparkSession
    model = train(labelled_findings(spark) if findings is None else findings)
    scored = with_features(candidates(documents, doc_id, text, path)).withColumn(
        "probability", F.expr(forest_sql(model))
    )
    return scored.select(
        "doc_id", "place", "candidate", "probability",
        (F.col("probability") >= threshold).alias("is_secret"),
    )
