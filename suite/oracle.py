"""The same queries in ANSI SQL over the same tables, written on their own terms.

Patterns are repeated here rather than imported, so a slip in one place shows.
"""

from __future__ import annotations

from suite.queries import ONE_MONTH

MONTHS = [f"{year}-{month:02d}" for year in range(1995, 2002) for month in range(1, 13)][:80]

# Suffix rules that the hosts of the tables need: 1 a suffix, 2 one label more, 4 an exception.
RULES = "('com', 1), ('net', 1), ('org', 1), ('be', 1)"
PRIVATE = "('com', 1), ('net', 1), ('org', 1), ('be', 1), ('example.net', 1), ('example.org', 2), ('spam-farm.example.org', 4)"

LINKS_BY_PAGE = """
links_by_page AS (
  SELECT page_id,
         CASE page_id % 10
           WHEN 0 THEN 'https://www.youtube.com/watch?v=' || substr(md5(CAST(page_id AS VARCHAR)), 1, 11) || '&feature=share'
           WHEN 3 THEN 'https://youtu.be/' || substr(md5(CAST(page_id AS VARCHAR)), 1, 11)
           WHEN 5 THEN 'https://www.youtube.com/channel/UC' || substr(md5(CAST(page_id AS VARCHAR)), 1, 22)
           WHEN 7 THEN 'https://m.youtube.com/@name' || CAST(page_id AS VARCHAR)
           ELSE url
         END AS link
  FROM pages)"""

POSTS = f"""{LINKS_BY_PAGE},
raw_posts AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
         CASE WHEN o_orderkey % 97 = 1 THEN 'no time' ELSE CAST(o_orderdate AS VARCHAR) END AS local_time,
         CAST(o_custkey AS VARCHAR) AS user_id,
         CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 500 + 1 AS VARCHAR) ELSE '0' END AS retweeted_id,
         CASE WHEN o_orderkey % 11 = 0 THEN ''
              WHEN o_orderkey % 13 = 0 THEN 'x'
              ELSE a.link || '|' || b.link || CASE WHEN o_orderkey % 5 = 0 THEN '|' ELSE '' END
         END AS links
  FROM orders
  JOIN links_by_page a ON a.page_id = o_orderkey % (SELECT count(*) FROM pages)
  JOIN links_by_page b ON b.page_id = (o_orderkey * 7 + 3) % (SELECT count(*) FROM pages)),
posts AS MATERIALIZED (
  SELECT nullif(id, '0') AS tweet_id,
         TRY_CAST(local_time AS TIMESTAMP) AS local_time,
         nullif(user_id, '0') AS user_id,
         CASE WHEN retweeted_id NOT IN ('0', '') THEN retweeted_id END AS retweeted_id,
         links,
         strftime(TRY_CAST(local_time AS TIMESTAMP), '%Y-%m') AS month
  FROM raw_posts
  WHERE length(links) > 1),
exploded AS MATERIALIZED (
  SELECT * FROM (
    SELECT tweet_id, local_time, user_id, retweeted_id, month, unnest(string_split(links, '|')) AS link FROM posts)
  WHERE link <> '')"""


def url_steps(source: str, values: str = RULES, aliases=("youtube.com", "youtu.be", "youtube-nocookie.com")) -> str:
    """CTEs that end in ``urls(link, normalized_url, domain_name)`` for a source's links."""
    folded = "domain"
    if aliases:
        names = ", ".join(f"'{alias}'" for alias in aliases)
        folded = f"CASE WHEN domain IN ({names}) THEN 'youtube.com' ELSE domain END"
    return rf"""
suffixes(suffix, flags) AS (VALUES {values}),
u0 AS (SELECT DISTINCT link, regexp_replace(link, '^[\x00-\x20]+|[\x00-\x20]+\z', '', 'g') AS trimmed FROM {source}),
u1 AS (
  SELECT link,
         CASE WHEN trimmed <> '' AND NOT regexp_matches(trimmed, '^(?i:mailto|javascript|data|tel|sms|about|blob|file):')
              THEN regexp_replace(regexp_replace(regexp_replace(trimmed, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^//', ''), '(?s)#.*', '')
         END AS body
  FROM u0),
u2 AS (
  SELECT link, body, regexp_extract(body, '^([^/?]*)', 1) AS authority,
         CASE WHEN contains(body, '?') THEN substr(body, instr(body, '?') + 1) ELSE '' END AS query,
         CASE WHEN contains(body, '?') THEN substr(body, 1, instr(body, '?') - 1) ELSE body END AS head
  FROM u1 WHERE body IS NOT NULL),
u3 AS (
  SELECT link,
         regexp_replace(lower(regexp_replace(authority, '(?s)^.*@', '')), ':(80|443)\z', '') AS host,
         regexp_replace(regexp_replace(substr(head, length(authority) + 1), '/index[.][a-z]+\z', ''), '/+\z', '') AS path,
         array_to_string(list_sort(list_filter(string_split(query, '&'),
           lambda part: part <> '' AND NOT regexp_matches(part, '^(utm_[a-z]+|fbclid|gclid|ref|feature)(=|\z)'))), '&') AS query
  FROM u2),
u4 AS (
  SELECT link, regexp_replace(host, ':.*', '') AS hostname,
         regexp_replace(host, '^(?:(?:www|m|mobile)[.])+([^.]+[.].+)\z', '\1')
           || path || CASE WHEN query = '' THEN '' ELSE '?' || query END AS normalized_url
  FROM u3 WHERE regexp_matches(host, '^[^/?#\x09-\x0d\x20]+\z')),
hosts AS (
  SELECT hostname, bare, string_split(bare, '.') AS labels
  FROM (SELECT DISTINCT hostname, regexp_replace(hostname, '[.]\z', '') AS bare FROM u4)),
tails AS (
  SELECT hostname, bare, labels, len(labels) AS n, size, array_to_string(labels[len(labels) - size + 1:], '.') AS tail
  FROM (SELECT hostname, bare, labels, unnest(range(1, len(labels) + 1)) AS size FROM hosts)),
found AS (
  SELECT hostname, any_value(labels) AS labels, any_value(n) AS n,
         coalesce(max(CASE WHEN flags & 4 <> 0 THEN size - 1 END),
                  nullif(max(greatest(CASE WHEN flags & 1 <> 0 THEN size ELSE 0 END,
                               CASE WHEN flags & 2 <> 0 AND n > size THEN size + 1 ELSE 0 END)), 0),
                  any_value(CASE WHEN NOT regexp_matches(bare, '(^|[.])[0-9]*\z|[\[\]:]') THEN 1 END)) AS size
  FROM tails LEFT JOIN suffixes ON suffix = tail GROUP BY hostname),
registered AS (
  SELECT hostname, array_to_string(labels[n - size:], '.') AS domain
  FROM found WHERE size > 0 AND n > size AND labels[n - size] <> ''),
urls AS MATERIALIZED (
  SELECT link, normalized_url, {folded} AS domain_name
  FROM (SELECT DISTINCT link FROM {source}) LEFT JOIN u4 USING (link) LEFT JOIN registered USING (hostname))"""


PAGE_URLS = f"WITH {LINKS_BY_PAGE}, {url_steps('links_by_page')}"
SHARES = f"""WITH {POSTS}, {url_steps('exploded')},
shares AS (
  SELECT md5(domain_name) AS domain_id, domain_name, normalized_url, link, retweeted_id, tweet_id, user_id, local_time, month
  FROM exploded JOIN urls USING (link))"""

DOMAIN_MONTH = f"""{SHARES},
domain_month AS (
  SELECT md5(domain_name) AS domain_id, domain_name, month, count(DISTINCT normalized_url) AS n_links,
         count(DISTINCT retweeted_id) AS n_retweeted, count(DISTINCT tweet_id) AS n_tweets, count(DISTINCT user_id) AS n_users
  FROM shares WHERE domain_name IS NOT NULL AND month IS NOT NULL GROUP BY domain_name, month)"""
LINK_MONTH = f"""{SHARES},
link_month AS (
  SELECT normalized_url, min(link) AS link_for_scraping, month, count(DISTINCT retweeted_id) AS n_retweeted,
         count(DISTINCT tweet_id) AS n_tweets, count(DISTINCT user_id) AS n_users
  FROM shares WHERE domain_name = 'youtube.com' AND normalized_url IS NOT NULL AND month IS NOT NULL
  GROUP BY normalized_url, month)"""


def _month_name(month: str) -> str:
    year, number = month.split("-")
    return f"nb_tweets_in_{year}_{int(number)}"


MONTH_SUMS = "".join(
    f"CAST(sum(CASE WHEN month = '{month}' THEN n_tweets ELSE 0 END) AS BIGINT) AS {_month_name(month)}, "
    for month in MONTHS
)
MONTH_NAMES = [_month_name(month) for month in MONTHS]


def _domains(months: str = "") -> str:
    return f"""
SELECT domain_id, domain_name,
       CAST(sum(n_links) AS BIGINT) AS nb_distinct_links_from_domain,
       CAST(sum(n_retweeted) AS BIGINT) AS nb_collected_retweets_with_domain,
       CAST(sum(n_tweets) AS BIGINT) AS sum_all_tweets_with_domain,
       CAST(sum(n_users) AS BIGINT) AS nb_accounts_that_shared_domain_link,
       {months}
       CAST(sum(n_tweets) - sum(n_retweeted) AS BIGINT) AS nb_collected_original_tweets
FROM domain_month GROUP BY domain_id, domain_name"""


def _links(months: str = "") -> str:
    return f"""
SELECT normalized_url, min(link_for_scraping) AS link_for_scraping,
       CAST(sum(n_retweeted) AS BIGINT) AS nb_collected_retweets_with_links,
       CAST(sum(n_tweets) AS BIGINT) AS sum_all_tweets_with_link,
       CAST(sum(n_users) AS BIGINT) AS nb_accounts_that_shared_link,
       {months}
       CAST(sum(n_tweets) - sum(n_retweeted) AS BIGINT) AS nb_collected_original_tweets
FROM link_month GROUP BY normalized_url"""


# Kind, video id and channel id of a normalised platform URL.
VIDEO_ID = r"""coalesce(
  nullif(regexp_extract(normalized_url, '^[^/]*youtube[^/]*/watch[?](?:.*&)?v=([A-Za-z0-9_-]{11})(?:&|\z)', 1), ''),
  nullif(regexp_extract(normalized_url, '^youtu[.]be/([A-Za-z0-9_-]{11})(?:[/?]|\z)', 1), ''),
  nullif(regexp_extract(normalized_url, '^[^/]*/(?:embed|v|shorts|live)/([A-Za-z0-9_-]{11})(?:[/?]|\z)', 1), ''))"""
LINK_KIND = r"""CASE WHEN video_id IS NOT NULL THEN 'video'
  WHEN regexp_matches(normalized_url, '^[^/]*/(?:channel/|c/|user/|@)') THEN 'channel' ELSE 'other' END"""
CHANNEL_ID = r"""CASE WHEN link_kind = 'channel' THEN
  nullif(regexp_extract(normalized_url, '^[^/]*/channel/(UC[A-Za-z0-9_-]{22})(?:[/?]|\z)', 1), '') END"""


def _classified(source: str) -> str:
    return f"""
classified AS (
  SELECT *, {CHANNEL_ID} AS channel_id FROM (
    SELECT *, {LINK_KIND} AS link_kind FROM (SELECT *, {VIDEO_ID} AS video_id FROM {source})))"""


PLATFORM_PAGES = f"""{PAGE_URLS},
platform_pages AS (
  SELECT page_id, link, normalized_url FROM links_by_page JOIN urls USING (link) WHERE domain_name = 'youtube.com'),
{_classified('platform_pages')}"""

METADATA = """
video_metadata AS (
  SELECT CASE WHEN page_id % 7 <> 1 THEN substr(md5(CAST(page_id AS VARCHAR)), 1, 11) END AS video_id,
         CASE WHEN page_id % 7 <> 0 THEN 'UC' || substr(md5(CAST(page_id % 4 * 10 + 5 AS VARCHAR)), 1, 22) END AS channel_id
  FROM pages)"""
RECORDS = f"""{METADATA},
video_records AS (
  SELECT m.video_id, m.channel_id, 'Video ' || CAST(page_id AS VARCHAR) AS video_title,
         CAST(length(html) AS BIGINT) AS "video_viewCount"
  FROM pages JOIN video_metadata m ON m.video_id = substr(md5(CAST(page_id AS VARCHAR)), 1, 11)),
channel_records AS (
  SELECT 'UC' || substr(md5(CAST(page_id AS VARCHAR)), 1, 22) AS channel_id,
         'Channel ' || CAST(page_id AS VARCHAR) AS channel_title, page_id * 3 AS "channel_videoCount"
  FROM pages)"""
WITH_CHANNEL = """
with_channel AS (
  SELECT c.* EXCLUDE (video_id, link_kind, channel_id), m.channel_id
  FROM classified c LEFT JOIN video_metadata m USING (video_id) WHERE link_kind = 'video'
  UNION ALL
  SELECT * EXCLUDE (video_id, link_kind, channel_id), channel_id FROM classified
  WHERE link_kind = 'channel' AND channel_id IS NOT NULL)"""


def _platform_links(months: str = "") -> str:
    return f"{LINK_MONTH}, platform_links AS ({_links(months)}), {_classified('platform_links')}, {METADATA}, {WITH_CHANNEL}"


def _channels(months) -> str:
    measures = [
        "nb_collected_retweets_with_links",
        "sum_all_tweets_with_link",
        "nb_accounts_that_shared_link",
        *months,
        "nb_collected_original_tweets",
    ]
    sums = ", ".join(f"CAST(sum({name}) AS BIGINT) AS {name}" for name in measures)
    return f"""
SELECT min(normalized_url) AS normalized_url, min(link_for_scraping) AS link_for_scraping, {sums},
       channel_id, count(channel_id) AS nb_links
FROM with_channel WHERE channel_id IS NOT NULL GROUP BY channel_id"""


_METADATA_NULLS = ", ".join(
    f"CAST(NULL AS {kind}) AS \"{name}\""
    for name, kind in {
        "channel_country": "VARCHAR",
        "channel_description": "VARCHAR",
        "channel_keywords": "VARCHAR",
        "channel_publishedAt": "TIMESTAMP",
        "channel_subscriberCount": "BIGINT",
        "channel_viewCount": "BIGINT",
        "video_commentCount": "BIGINT",
        "video_description": "VARCHAR",
        "video_duration": "VARCHAR",
        "video_favoriteCount": "BIGINT",
        "video_likeCount": "BIGINT",
        "video_publishedAt": "TIMESTAMP",
        "video_tags": "VARCHAR",
    }.items()
)

DOMAIN_MONTH_SQL = f"{DOMAIN_MONTH} SELECT * FROM domain_month"
DOMAINS_TOTAL_SQL = DOMAIN_MONTH + _domains()
LINK_MONTH_SQL = f"{LINK_MONTH} SELECT * FROM link_month"
CHANNELS_SQL = _platform_links(MONTH_SUMS) + _channels(MONTH_NAMES)
ORDERS_MONTH = """
SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month, count(DISTINCT o_custkey) AS n_customers,
       count(DISTINCT o_orderkey) AS n_orders, count(DISTINCT o_orderstatus) AS n_statuses, min(o_orderstatus) AS first_status
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2"""

# The domain that each host of ``suffix_links`` belongs to, written out.
SUFFIX_DOMAINS = """
SELECT page_id, CASE page_id % 17
  WHEN 0 THEN 'site' || n || '.com' WHEN 1 THEN 'site' || n || '.co.uk' WHEN 2 THEN 'site' || n || '.bar'
  WHEN 3 THEN 'foo' || n || '.google' WHEN 4 THEN 'site' || n || '.com.hk' WHEN 5 THEN 'b' || n || '.go.jp'
  WHEN 6 THEN 'user' || n || '.github.io' WHEN 7 THEN 'example' || n || '.bzh' WHEN 9 THEN 'site' || n || '.рф'
  WHEN 10 THEN 'shop' || n || '.foo.ck' WHEN 11 THEN 'www.ck' WHEN 12 THEN 'site' || n || '.org'
  WHEN 13 THEN 'site' || n || '.xn--p1ai' WHEN 14 THEN 'site' || n || '.公司.cn' WHEN 15 THEN 'site' || n || '.xn--55qx5d.cn'
  WHEN 16 THEN 'été' || n || '.com' END AS domain_name
FROM (SELECT page_id, page_id % 40 AS n FROM pages)"""
# The same under the rules of the file: bar and *.hk, but neither com.hk nor github.io.
FILE_DOMAINS = SUFFIX_DOMAINS.replace("WHEN 1 THEN 'site' || n || '.co.uk'", "WHEN 1 THEN 'co.uk'").replace("WHEN 5 THEN 'b' || n || '.go.jp'", "WHEN 5 THEN 'go.jp'").replace(
    "WHEN 6 THEN 'user' || n || '.github.io'", "WHEN 6 THEN 'github.io'"
).replace("WHEN 10 THEN 'shop' || n || '.foo.ck' WHEN 11 THEN 'www.ck'", "WHEN 10 THEN 'foo.ck' WHEN 11 THEN 'www.ck'")
REJECTED = f"""{SHARES} SELECT count(*) AS nb_shares, count(*) - count(month) AS nb_without_time,
count(*) - count(normalized_url) AS nb_without_url, count(*) - count(domain_name) AS nb_without_domain FROM shares"""

ORACLE_SQL: dict[str, str] = {
    "links_exploded": f"WITH {POSTS} SELECT tweet_id, user_id, link FROM exploded",
    "zero_token_null": f"WITH {POSTS} SELECT tweet_id, user_id, retweeted_id FROM posts",
    "shares_projected": f"WITH {POSTS} SELECT tweet_id, local_time, user_id, retweeted_id, month FROM posts",
    "shares": f"{SHARES} SELECT * FROM shares",
    "url_normalized": f"{PAGE_URLS} SELECT page_id, link, normalized_url FROM links_by_page JOIN urls USING (link)",
    "url_domain": f"""WITH page_list AS (SELECT page_id, url AS link FROM pages), {url_steps('page_list', aliases=())}
SELECT page_id, domain_name FROM page_list JOIN urls USING (link)""",
    "url_domain_private": f"""WITH page_list AS (SELECT page_id, url AS link FROM pages),
{url_steps('page_list', PRIVATE)}
SELECT page_id, domain_name FROM page_list JOIN urls USING (link)""",
    "domain_alias": f"{PAGE_URLS} SELECT page_id, domain_name FROM links_by_page JOIN urls USING (link)",
    "domain_key": f"{PAGE_URLS} SELECT page_id, md5(domain_name) AS domain_id FROM links_by_page JOIN urls USING (link)",
    "domain_month": DOMAIN_MONTH_SQL,
    "months_present": f"{SHARES} SELECT DISTINCT month FROM shares WHERE month IS NOT NULL",
    "domains_total": DOMAINS_TOTAL_SQL,
    "domains_by_month_wide": DOMAIN_MONTH + _domains(MONTH_SUMS),
    "merged_halves": DOMAINS_TOTAL_SQL,
    "one_month": f"{DOMAIN_MONTH} SELECT * FROM domain_month WHERE month = '{ONE_MONTH}'",
    "orders_monthly_rollup": ORDERS_MONTH,
    "orders_merged": f"""SELECT o_orderpriority, CAST(sum(n_customers) AS BIGINT) AS n_customers,
CAST(sum(n_orders) AS BIGINT) AS n_orders, CAST(sum(n_statuses) AS BIGINT) AS n_statuses, min(first_status) AS first_status
FROM ({ORDERS_MONTH}) GROUP BY 1""",
    "events_month_rollup": """SELECT event_type, strftime(ts, '%Y-%m') AS month, count(DISTINCT user_id) AS n_users,
count(DISTINCT event_id) AS n_events FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""",
    "lineitem_month_totals": """SELECT l_suppkey, CAST(sum(n_orders) AS BIGINT) AS n_orders, CAST(sum(n_parts) AS BIGINT) AS n_parts
FROM (SELECT l_suppkey, strftime(l_shipdate, '%Y-%m') AS month, count(DISTINCT l_orderkey) AS n_orders,
             count(DISTINCT l_partkey) AS n_parts
      FROM lineitem WHERE l_returnflag <> 'N' AND l_shipdate IS NOT NULL GROUP BY 1, 2) GROUP BY 1""",
    "platform_link_month": LINK_MONTH_SQL,
    "platform_links_wide": LINK_MONTH + _links(MONTH_SUMS),
    "link_kind": f"{PLATFORM_PAGES} SELECT * FROM classified",
    "video_link_table": f"""{_platform_links()}
SELECT * EXCLUDE (video_id, link_kind, channel_id) FROM classified WHERE link_kind = 'video'""",
    "channel_link_table": f"""{_platform_links()}
SELECT * EXCLUDE (video_id, link_kind) FROM classified WHERE link_kind = 'channel' AND channel_id IS NOT NULL""",
    "video_enriched": f"""{PLATFORM_PAGES}, {METADATA}
SELECT page_id, link, normalized_url, m.channel_id
FROM classified c LEFT JOIN video_metadata m USING (video_id) WHERE link_kind = 'video'""",
    "metadata_inner": f"""{PLATFORM_PAGES}, {RECORDS}
SELECT page_id, link, normalized_url, r.video_id, r.channel_id, r.video_title, r."video_viewCount",
       CAST(NULL AS VARCHAR) AS channel_title, CAST(NULL AS BIGINT) AS "channel_videoCount", {_METADATA_NULLS}
FROM classified c JOIN video_records r USING (video_id) WHERE link_kind = 'video'
UNION ALL
SELECT page_id, link, normalized_url, CAST(NULL AS VARCHAR), r.channel_id, CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT),
       r.channel_title, r."channel_videoCount", {_METADATA_NULLS}
FROM classified c JOIN channel_records r USING (channel_id) WHERE link_kind = 'channel'""",
    "links_with_channel": f"{_platform_links()} SELECT * FROM with_channel",
    "channels": CHANNELS_SQL,
    "channels_without_metadata": _platform_links().replace(
        "LEFT JOIN video_metadata m", "LEFT JOIN (SELECT * FROM video_metadata WHERE false) m"
    )
    + _channels([]),
    "duplicate_keys": f"""{SHARES} SELECT tweet_id, domain_name, count(*) AS nb_rows FROM shares
GROUP BY tweet_id, domain_name HAVING count(*) > 1""",
    "rejected_rows": REJECTED,
    "nameless_channel_links": f"""{PLATFORM_PAGES}
SELECT count(*) FILTER (WHERE link_kind = 'channel' AND channel_id IS NULL) AS nb_channel_links_without_id FROM classified""",
    "csv_roundtrip": DOMAINS_TOTAL_SQL,
    "csv_split": DOMAINS_TOTAL_SQL,
    "quarantine": """WITH t AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS a, CAST(o_orderdate AS VARCHAR) AS b, CAST(o_custkey AS VARCHAR) AS c,
         '"https://site' || CAST(o_orderkey % 50 AS VARCHAR) || '.com/a,b"' AS link FROM orders)
SELECT 'malformed row' AS reason, a || ',' || b || ',' || c AS raw_row, true AS has_file FROM t WHERE k % 41 = 1
UNION ALL SELECT 'malformed row', a || ',' || b || ',' || c || ',0,' || link || ',more', true FROM t WHERE k % 41 <> 1 AND k % 43 = 1
UNION ALL SELECT 'unreadable time', a || ',soon,' || c || ',0,' || link, true FROM t WHERE k % 41 <> 1 AND k % 43 <> 1 AND k % 47 = 1
UNION ALL SELECT 'shared', CAST(count(*) AS VARCHAR), true FROM t WHERE k % 41 <> 1 AND k % 43 <> 1 AND k % 47 <> 1""",
    "bronze_roundtrip": LINK_MONTH_SQL,
    "parsed_links_read": f"{SHARES} SELECT * FROM shares",
    "metadata_roundtrip": f"WITH {METADATA} SELECT video_id, channel_id FROM video_metadata",
    "records_roundtrip": f"""WITH {RECORDS},
v AS (SELECT *, CAST(substr(video_title, 7) AS BIGINT) AS k FROM video_records)
SELECT video_id, channel_id, video_title, CASE WHEN k % 7 <> 2 THEN "video_viewCount" END AS "video_viewCount",
       CAST(NULL AS VARCHAR) AS channel_title, CAST(NULL AS BIGINT) AS "channel_videoCount", {_METADATA_NULLS} FROM v
UNION ALL
SELECT NULL, channel_id, NULL, NULL, channel_title, "channel_videoCount", {_METADATA_NULLS} FROM channel_records""",
    "bad_records": f"""WITH {RECORDS},
v AS (SELECT CAST(substr(video_title, 7) AS BIGINT) AS k FROM video_records),
f(field) AS (VALUES ('channel_publishedAt'), ('channel_subscriberCount'), ('channel_videoCount'), ('channel_viewCount'),
  ('video_commentCount'), ('video_favoriteCount'), ('video_likeCount'), ('video_publishedAt'), ('video_viewCount'))
SELECT field, CASE field WHEN 'video_viewCount' THEN (SELECT count(*) FROM v)
                         WHEN 'channel_videoCount' THEN (SELECT count(*) FROM channel_records) ELSE 0 END AS nb_values,
       CASE field WHEN 'video_viewCount' THEN (SELECT count(*) FROM v WHERE k % 7 = 2) ELSE 0 END AS nb_bad FROM f""",
    "shares_stored": f"{SHARES} SELECT * FROM shares WHERE month = '{ONE_MONTH}'",
    "month_refresh": DOMAIN_MONTH_SQL,
    "versioned_refresh": DOMAIN_MONTH_SQL,
    "month_append": LINK_MONTH_SQL,
    "pipeline_channels": CHANNELS_SQL,
    "resume": DOMAIN_MONTH + _domains(MONTH_SUMS),
    "url_domain_suffixes": SUFFIX_DOMAINS,
    "suffix_file": FILE_DOMAINS,
    "pipeline_refresh": REJECTED,
    "parsed_links_job": DOMAIN_MONTH + _domains(MONTH_SUMS),
    "stored_months": f"{SHARES} SELECT DISTINCT month FROM shares WHERE month IS NOT NULL",
    "links_by_kind": f"{_platform_links()} SELECT * FROM classified",
    "export_domains_order": f"""{DOMAIN_MONTH}, t AS ({_domains()})
SELECT domain_id, row_number() OVER (ORDER BY sum_all_tweets_with_domain DESC, domain_id) AS place FROM t""",
    "export_links_order": f"""{LINK_MONTH}, t AS ({_links()})
SELECT normalized_url, row_number() OVER (ORDER BY sum_all_tweets_with_link DESC, normalized_url) AS place FROM t""",
    "export_channels_order": f"""{_platform_links()}, t AS ({_channels([])})
SELECT channel_id, row_number() OVER (ORDER BY sum_all_tweets_with_link DESC, channel_id) AS place FROM t""",
}
