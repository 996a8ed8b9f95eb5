"""URL filter rules that are looked up by their rarest literal token."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """``||host/path`` fits a host, its subdomains and paths that start so; any other pattern is searched for in
    host, path and query. ``*`` stands for any characters, ``|`` at the end for the end of the URL."""

    verdict: str
    pattern: str

    @property
    def is_host_rule(self) -> bool:
        return self.pattern.startswith("||")


# The rules on hosts and paths.
HOST_RULES = (
    Rule("allow", "||com/"),
    Rule("block", "||example.com/en/"),
    Rule("allow", "||www.example.com/en/"),
    Rule("block", "||net/es/"),
    Rule("block", "||net/fr/"),
)
# What is blocked elsewhere: pages behind a login, shops' baskets, trackers, advertisements, programs.
PATTERN_RULES = (
    Rule("block", "/login/"), Rule("block", "/signup/"), Rule("block", "/logout/"), Rule("block", "/cart/"),
    Rule("block", "/checkout/"), Rule("block", "/wp-admin/"), Rule("block", "?sessionid="), Rule("block", "&sessionid="),
    Rule("block", "/ads/"), Rule("block", "/adserver/"), Rule("block", ".doubleclick."), Rule("block", "/casino/"),
    Rule("block", ".casino/"), Rule("block", "/porn/"), Rule("block", ".xxx/"), Rule("block", ".exe|"), Rule("block", ".apk|"),
    Rule("allow", "/ads/policy/*.html"),
)

_TOKEN = re.compile("[a-z0-9]+")


def tokens_of(pattern: str) -> list[str]:
    """Literal tokens that every URL the pattern fits must hold as whole tokens, in lower case.

    A run of letters and digits that touches ``*`` or an open end of the pattern may be part of a longer token.
    """
    open_start = not pattern.startswith("||")
    open_end = not pattern.endswith("|")
    body = pattern.removeprefix("||").removesuffix("|").lower()
    found = []
    for m in _TOKEN.finditer(body):
        before = body[m.start() - 1] if m.start() else ("*" if open_start else "^")
        after = body[m.end()] if m.end() < len(body) else ("*" if open_end else "$")
        if before != "*" and after != "*":
            found.append(m[0])
    return found


def _regex(pattern: str) -> re.Pattern:
    body = ".*".join(re.escape(part) for part in pattern.removeprefix("||").removesuffix("|").split("*"))
    # A host ends at its path or query.
    start = r"\A(?:[^/?]*\.)?" if pattern.startswith("||") else ""
    return re.compile(start + body + (r"\Z" if pattern.endswith("|") else ""), re.DOTALL)


def _parts(url):
    """Host, path and the text that rules are searched in. Only A-Z of the host are lower-cased."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(permalink, instr(permalink, '://') + 3)"))
    whole = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(whole, "(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tail = F.regexp_extract(whole, "(?s)^[^/?#]*([^#]*)", 1)
    return host, F.regexp_extract(tail, "(?s)^([^?]*)", 1), F.concat(host, tail)


def judge_links(posts: DataFrame, rules: Iterable[Rule] = (*HOST_RULES, *PATTERN_RULES)) -> DataFrame:
    """Judge the ``permalink`` of every post by pattern rules.

    Each rule is filed under the one of its literal tokens that occurs in the fewest URLs of the table (counted
    over all of them first). A URL's tokens fetch the rules filed under them, and only those run their regular
    expression; rules without a whole literal token run on every URL. What travels to the tasks is the rule list,
    a parameter, and its size does not depend on the posts; no rows are shuffled apart from token counts.

    Of the host rules that fit, the longest decides. Without one the longest fitting pattern decides, ``block`` before
    ``allow`` at equal length; with none the URL is allowed.

    Returns ``id``, ``permalink``, ``host``, ``path``, ``rule`` (the host rule, like ``net/es/``), ``pattern`` (the other
    pattern that decided), ``verdict`` and ``n_checked``, the number of regular expressions run. One row per row of
    ``posts``, repeated rows included. Null URLs and those without ``://`` have empty host and path and are
    allowed unless a pattern fits.
    """
    rules = list(dict.fromkeys(rules))
    host, path, target = _parts(F.col("permalink"))
    links = posts.select("id", "permalink").select("id", "permalink", host.alias("host"), path.alias("path"), target.alias("target"))
    literal = {rule: tokens_of(rule.pattern) for rule in rules}
    names = sorted({token for tokens in literal.values() for token in tokens})
    counts = {}
    if names:
        wanted = posts.sparkSession.createDataFrame([(n,) for n in names], "token string")
        held = links.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("target"), F.lit("[a-z0-9]+"), 0))).alias("token"))
        # The tokens of the rules are a parameter, so their size is bounded and a frequent token is never gathered.
        counts = dict(held.join(F.broadcast(wanted), "token", "left_semi").groupBy("token").count().collect())
    index: dict[str, list[Rule]] = {}
    always = [rule for rule in rules if not literal[rule]]
    for rule, tokens in literal.items():
        if tokens:
            index.setdefault(min(tokens, key=lambda t: (counts.get(t, 0), t)), []).append(rule)
    schema = "id {0}, permalink string, host string, path string, rule string, pattern string, verdict string, n_checked long"
    return links.mapInArrow(
        lambda batches: _judge(batches, index, always), schema.format(links.schema["id"].dataType.simpleString())
    )


def _judge(batches: Iterator[pa.RecordBatch], index: dict[str, list[Rule]], always: list[Rule]) -> Iterator[pa.RecordBatch]:
    regex = {rule: _regex(rule.pattern) for rule in [*always, *(r for rules in index.values() for r in rules)]}
    names = ["rule", "pattern", "verdict", "n_checked"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        out = []
        for target in batch["target"].to_pylist():
            found = [*always]
            for token in set(_TOKEN.findall(target.lower())):
                found += index.get(token, ())
            fits = [rule for rule in found if regex[rule].search(target)]
            hosts = [r for r in fits if r.is_host_rule]
            best = max(hosts or fits, key=lambda r: (len(r.pattern), r.verdict == "block", r.pattern), default=None)
            text = best and best.pattern.removeprefix("||")
            out.append((text if hosts else None, None if hosts else text, best.verdict if best else "allow", len(found)))
        columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
        kept = ["id", "permalink", "host", "path"]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *columns], names=[*kept, *names])
