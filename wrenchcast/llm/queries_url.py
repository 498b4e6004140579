"""Query of operator 1 over the whole table ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .url_filter import Rule, host_and_path, url_verdicts

# Fixed rules of the query.
RULES = [Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
         Rule("allow", "com/fr/"), Rule("block", "com/de/")]
# Fixed words of the query: a host is on the list if one of its labels, cut at '.' and '-', is one of them. They are
# the usual headings of public lists of unwanted sites (advertising, adult, gambling, drugs, fraud, malware, piracy), in
# singular and plural; none is read off the pages.
LISTED_WORDS = [
    "ad", "ads", "advert", "adverts", "adserver", "banner", "banners", "tracker", "trackers",
    "adult", "escort", "escorts", "porn", "sex", "xxx",
    "bet", "bets", "betting", "casino", "casinos", "gambling", "lottery", "poker", "slot", "slots",
    "drug", "drugs", "pharmacy", "pill", "pills", "viagra",
    "fraud", "phishing", "scam", "scams", "spam",
    "botnet", "malware", "ransomware", "spyware", "trojan", "virus",
    "crack", "cracks", "keygen", "torrent", "torrents", "warez"]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    host = pages.select(host_and_path(F.col("url"))[0].alias("key")).distinct()
    words = F.array(*[F.lit(w) for w in LISTED_WORDS])
    listed = host.where(F.arrays_overlap(F.split("key", "[.-]"), words))
    return url_verdicts(pages, RULES, listed).drop("listed")


_FITS = " ".join(
    f"when (host = '{r.host}' or host like '%.{r.host}') and starts_with(path, '{r.path}') then '{{{i}}}'"
    for i, r in sorted(enumerate(RULES), key=lambda x: (-len(x[1].rule), -len(x[1].host))))

OP1_SQL = f"""
with cut as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
parts as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as raw, rest from cut),
judged as (
  select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from parts)
select page_id, host, path,
  case {_FITS.format(*[r.rule for r in RULES])} else null end as rule,
  case {_FITS.format(*[r.verdict for r in RULES])}
       when list_has_any(regexp_split_to_array(host, '[.-]'), {LISTED_WORDS}) then 'block' else 'allow' end as verdict
from judged
"""

QUERIES = {"op1_url_filter": op1_url_filter}
ORACLE = {"op1_url_filter": OP1_SQL}
