"""URL filter: host and path rules, then a weighted vocabulary counted by one Aho-Corasick pass.

A term counts where it stands between boundaries (no letter or digit next to it).  One strict term rejects a url, and
so do several distinct soft terms that weigh ``soft_needed`` together.  Forms of one word (ad, ads) are one soft term: they share a root,
and a root counts once however often its forms occur.  Allow and block rules name a host with its subdomains and a path
prefix; the longest rule that fits decides before the vocabulary does.
"""

from typing import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

#: General vocabulary of the production query.  Terms are lower-case ASCII letters and digits.  A strict term has no
#: innocent use in a url to speak of: one is enough.
STRICT_TERMS = tuple("porn porno pornography pornstar pornstars xxx hentai milf camgirl camgirls sexcam sexcams "
                     "warez keygen keygens torrentz casino casinos viagra cialis levitra phentermine payday malware".split())
#: Words that mostly stand on pages to reject (weight 2), a root and its forms on a line, then words that also
#: stand on any shop's or bank's pages (weight 1).  A weak word alone, or two, reject nothing.
_STRONG = """
adult adults|babe babes|cam cams webcam webcams|escort escorts|erotic erotica|fetish|hookup hookups|naked|nude nudes|nsfw|sex sexy
bet bets betting|blackjack|bingo|bookmaker bookmakers|gamble gambling|jackpot jackpots|lottery lotto|poker|roulette|slot slots|sportsbook|wager
pharma|pharmacy pharmacies|pill pills|rx|steroid steroids|weightloss
freebie freebies|giveaway|replica replicas
crack cracked cracks|hack hacks|pirate pirated|serial serials|torrent torrents
ad ads adserver|adware|clickbait|popup popups popunder|tracker trackers
backlink backlinks|doorway|linkfarm|phish phishing|scam scams|spam spammer|spyware"""
_WEAK = """
dating|hot|singles
odds|stakes|win winner
diet|drug drugs|meds|prescription|supplements
bargain|bonus bonuses|cash|cheap|coupon coupons|deal deals|discount discounts|earn|free|loan loans|money|offer offers|prize prizes|promo promos|rich|sale
download downloads|mp3
affiliate affiliates|banner banners|beacon|click clicks|impression impressions|pixel|retarget|sponsor sponsored|track tracking
bulk|seo|traffic"""
#: (weight, forms) of each soft root.
SOFT_ROOTS = tuple((weight, tuple(forms.split())) for weight, text in ((2, _STRONG), (1, _WEAK)) for forms in text.strip().replace("\n", "|").split("|"))
SOFT_TERMS = tuple(form for _, forms in SOFT_ROOTS for form in forms)
SOFT_NEEDED = 3

#: (verdict, host, path) of the production query.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def split_url(url):
    """(host, path) columns; both empty for a null url or one without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(url.contains("://"), F.expr("substr(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return lower_ascii(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _counter(strict: tuple, soft: tuple):
    def alnum(c: str) -> bool:
        return c.isascii() and c.isalnum()

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = ahocorasick.Automaton()                  # once a task, not once a batch
        for t in strict:
            machine.add_word(t, (0, t, 0))
        for root, (weight, forms) in enumerate(soft):
            for t in forms:
                machine.add_word(t, (1, t, root))
        machine.make_automaton()
        weights = [w for w, _ in soft]

        def hits(url):
            low = url.lower() if url else ""
            bad, roots = set(), set()
            for end, (kind, term, root) in machine.iter(low):
                start = end - len(term) + 1
                if (start == 0 or not alnum(low[start - 1])) and (end + 1 == len(low) or not alnum(low[end + 1])):
                    if kind:
                        roots.add(root)
                    else:
                        bad.add(term)
            return len(bad), len(roots), sum(weights[r] for r in roots)

        for urls in batches:
            yield pd.DataFrame([hits(u) for u in urls], columns=["strict", "soft", "weight"], dtype="int32")
    return F.pandas_udf(count, "strict int, soft int, weight int")


def filter_urls(pages: DataFrame, rules=RULES, strict=STRICT_TERMS, soft=SOFT_ROOTS, soft_needed: int = SOFT_NEEDED) -> DataFrame:
    """(page_id, host, path, rule, verdict, strict_hits, soft_hits, soft_weight), one row per row of ``pages`` (page_id, url, ...).

    ``soft``: (weight, forms) of each root; ``soft_hits`` counts the roots met.  At least two of them, weighing ``soft_needed`` together, reject.
    Longest rule: most characters of host plus path; a tie goes to the longer host, then to block.  A null or
    empty url has no host and no path, fits no rule and holds no term: allowed.  Repeated rows stay; other columns are ignored.
    """
    if not (strict or soft):
        raise ValueError("the vocabulary is empty")
    forms = [t.lower() for _, f in soft for t in f] + [t.lower() for t in strict]
    if len(set(forms)) < len(forms):
        raise ValueError("a term stands twice in the vocabulary")
    count = _counter(tuple(t.lower() for t in strict), tuple((w, tuple(t.lower() for t in f)) for w, f in soft))
    judged = pages.select("page_id", F.col("url").cast("string").alias("url"))
    host, path = split_url(F.col("url"))
    judged = judged.select("page_id", host.alias("host"), path.alias("path"), count("url").alias("hits"))
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    rule = verdict = None
    for v, h, p in order:
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    method = F.when((F.col("hits.strict") >= 1) | ((F.col("hits.soft") >= 2) & (F.col("hits.weight") >= soft_needed)), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", (rule if rule is not None else F.lit(None).cast("string")).alias("rule"),
                         (verdict.otherwise(method) if verdict is not None else method).alias("verdict"),
                         F.col("hits.strict").alias("strict_hits"), F.col("hits.soft").alias("soft_hits"),
                         F.col("hits.weight").alias("soft_weight"))
