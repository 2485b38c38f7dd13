"""Sources, ingest, sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions.expr import clean_nonfinite
from tidemark.operators import ingest as op
from tidemark.plans.catalogue import livelog
from tidemark.plans.catalogue.registry import query, report
from tidemark.plans.catalogue.sqltext import chain
from tidemark.plans.workspace import Workspace, _stored
from tidemark.session import materialise, shared_dir
from tidemark.sources import bars as src
from tidemark.sources import orders as books
from tidemark.sources import sinks

BAR = ["ticker", "date", "open", "high", "low", "close", "volume", "turnover"]
OHLC = ["open", "high", "low", "close"]
CUT, TAIL = "2001-09-01", "2001-06-01"


def base(ws):
    return ws.symbols().where(F.col("date") <= F.lit(CUT).cast("date")).select(*BAR)


def batch(ws):
    """New batch: last digit 1 = full history rescaled, 2 = tail rescaled, 3 = full history unchanged, 4 = tail with repeated keys."""
    m = F.col("sid") % 10
    d = ws.symbols().where(m.isin(1, 3) | (F.col("date") > F.lit(TAIL).cast("date")))
    k = F.when(m.isin(1, 2), 0.9).otherwise(1.0)
    d = d.withColumns({c: F.col(c) * k for c in OHLC})
    d = d.withColumn("seq", F.explode(F.when(m == 4, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return d.withColumn("volume", F.when(F.col("seq") == 1, F.col("volume") * 2).otherwise(F.col("volume"))).select(*BAR, "seq")


BATCH = f"""
base as (select ticker, date, open, high, low, close, volume, turnover from sym where date <= date '{CUT}'),
nb as (select ticker, date, open*k as open, high*k as high, low*k as low, close*k as close, case when seq = 1 then volume*2 else volume end volume, turnover, seq
   from (select *, case when sid % 10 in (1,2) then 0.9e0 else 1e0 end k, unnest(case when sid % 10 = 4 then [0, 1] else [0] end) seq
         from sym where sid % 10 in (1,3) or date > date '{TAIL}')),
ws0 as (select ticker, max(abs(nb.close/base.close-1)) worst from base join nb using (ticker, date) group by 1),
bs as (select * from (select n.ticker, n.n, case when coalesce(worst > 0.005e0, false) and n >= 260 then 'replaced' when coalesce(worst > 0.005e0, false) then 'quarantine'
   when n >= 260 then 'revalidated' end status from (select ticker, count(*) n from nb group by 1) n left join ws0 using (ticker)) where status is not null)"""
MERGED = """
mg0 as (select *, 0 s, 0 q from base where ticker not in (select ticker from bs where status = 'replaced')
   union all select * exclude (seq), 1, seq from nb where ticker not in (select ticker from bs where status = 'quarantine')),
mg as (select * exclude (s, q, rn) from (select *, row_number() over (partition by ticker, date order by s desc, q desc) rn from mg0) where rn = 1)"""
SYM = chain("sym")
M = SYM + "," + BATCH + "," + MERGED


@query("S01_read_bars", SYM + "\n" + report("sym", "ticker date", "open high low close volume turnover"))
def read_bars(ws):
    """Bars written as CSV and read back with a declared schema, united with the parquet half."""
    path = f"{shared_dir(ws.spark)}/{ws.spark.sparkContext.applicationId}/{uuid.uuid4().hex[:12]}"
    d = ws.symbols().select(*BAR)
    half = F.pmod(F.xxhash64("ticker"), F.lit(2)) == 0
    d.where(half).write.option("header", True).csv(f"{path}/bars.csv")
    d.where(~half).write.parquet(f"{path}/bars.parquet")
    csv = src.read_bars(ws.spark, f"{path}/bars.csv", src.CSV_SCHEMA).withColumn("date", F.to_date("date"))
    return csv.unionByName(src.read_bars(ws.spark, f"{path}/bars.parquet"))


@query("S02_normalise", chain("sym") + "\n" + report("sym", "ticker date", "open high low close volume turnover"))
def normalise(ws):
    """Foreign headers, padded lower-case codes, timestamps."""
    d = ws.symbols().select(F.concat(F.lit(" "), F.lower("ticker"), F.lit(" ")).alias("Symbol"), (F.col("date").cast("timestamp") + F.expr("interval 9 hours")).alias(" TradingDate"),
                            F.col("open").alias("OPEN"), F.col("high").alias("High"), "low", "close", "volume", F.col("turnover").alias("GTGD"), F.lit(1).alias("junk"))
    return src.normalise(d)


@query("S03_fill_turnover", SYM + ", t as (select ticker, date, case when sid % 4 = 0 then close*volume*1000 else turnover end turnover from sym)\n"
       + report("t", "ticker date", "turnover", digits=2), digits=2)
def fill_turnover(ws):
    """Missing turnover estimated from close and volume."""
    d = ws.symbols().withColumn("turnover", F.when(F.col("sid") % 4 != 0, F.col("turnover")))
    return src.fill_turnover(d).select("ticker", "date", "turnover")


@query("S04_split_index", chain("sym", "idx") + """, u as (select 'stock' kind, ticker, date, close from sym union all select 'index', ticker, date, close from idx)\n"""
       + report("u", "kind ticker date", "close"))
def split_index(ws):
    """Index rows under either spelling taken out of a mixed file."""
    alt = F.when(F.dayofyear("date") % 2 == 0, "VN-INDEX").otherwise("VNINDEX")
    cols = BAR[:7]
    mixed = ws.symbols().select(*cols).unionByName(ws.index().withColumn("ticker", alt).select(*cols))
    stock, idx = src.split_index(mixed)
    return stock.select(F.lit("stock").alias("kind"), "ticker", "date", "close").union(idx.select(F.lit("index"), "ticker", "date", "close"))


@query("S05_upsert", SYM + "," + BATCH + """, u0 as (select *, 0 s, 0 q from base union all select * exclude (seq), 1, seq from nb),
u as (select * from u0 qualify row_number() over (partition by ticker, date order by s desc, q desc) = 1)\n""" + report("u", "ticker date", "open high low close volume turnover"))
def upsert(ws):
    """Keyed upsert, last write wins."""
    return op.upsert(base(ws), batch(ws), seq="seq")


@query("S06_reconcile", M + "\n" + report("mg", "ticker date", "open high low close volume turnover"))
def reconcile(ws):
    """Panel after adjustment detection."""
    return op.reconcile(base(ws), batch(ws), ws.cfg, "seq")[0]


@query("S06_batch_status", SYM + "," + BATCH + "\nselect ticker, status, n from bs")
def batch_status(ws):
    """Tickers replaced, quarantined or revalidated."""
    return op.batch_status(base(ws), batch(ws), ws.cfg)


@query("S07_ingest_report", M + """
select (select count(*) from bs where status='replaced') replaced, (select count(*) from bs where status='quarantine') quarantine,
  (select count(*) from bs where status='revalidated') revalidated,
  (select count(*) from mg) - (select count(*) from base where ticker not in (select ticker from bs where status='replaced')) rows_new""")
def ingest_report(ws):
    """Row accounting of the batch."""
    b = base(ws)
    merged, status = op.reconcile(b, batch(ws), ws.cfg, "seq")
    return op.ingest_report(b, merged, status)


def _provider(ws):
    """Last 12 sessions of each ticker as fetched now, every fifth ticker rescaled; and the full history."""
    k = F.when(F.col("sid") % 5 == 1, 0.95).otherwise(1.0)
    full = ws.symbols().withColumns({c: F.col(c) * k for c in OHLC})
    return full.where("date > date '2001-08-12'").select(*BAR[:7]), full.select(*BAR[:7])


@query("S08_cdc_merge", SYM + f"""
, base as (select * from sym where date <= date '{CUT}'),
fu as (select ticker, date, open*k as open, high*k as high, low*k as low, close*k as close, volume from (select *, case when sid % 5 = 1 then 0.95e0 else 1e0 end k from sym)),
re as (select *, dense_rank() over (partition by ticker order by date desc) k from fu where date > date '2001-08-12'),
rp as (select r.ticker from re r join base b using (ticker, date) where r.k > 5 group by 1 having max(abs(r.close/b.close-1)) > 0.005e0),
ad as (select ticker, date, open, high, low, close, volume, close*volume*1000 turnover from re where k <= 5 and ticker not in (select ticker from rp)),
u as (select ticker, date, open, high, low, close, volume, turnover from base where ticker not in (select ticker from rp) and (ticker, date) not in (select (ticker, date) from ad)
   union all select * from ad union all select ticker, date, open, high, low, close, volume, close*volume*1000 from fu where ticker in (select ticker from rp))\n"""
       + report("u", "ticker date", "open high low close volume turnover", turnover=2), turnover=2)
def cdc_merge(ws):
    """Provider update merged into the panel."""
    recent, full = _provider(ws)
    return op.cdc_merge(base(ws), recent, full, ws.cfg)[0]


@query("S09_clean_check", SYM + """
select sum(n-1)::bigint dups, sum(np)::bigint nonpositive, sum(hl)::bigint high_lt_low from (select count(*) n, count(*) filter (least(open,high,low,close) <= 0) np,
  count(*) filter (high < low) hl from sym group by ticker, date)""")
def clean_check(ws):
    """Hard checks before a write; raises when one fails."""
    return op.clean_counts(op.assert_clean(ws.symbols()))


def _raw(ws):
    """Bars as text, some unreadable, some impossible."""
    m = F.col("sid") % 20
    d = ws.symbols().select("sid", "ticker", F.col("date").cast("string").alias("date"), *[F.col(c).cast("string").alias(c) for c in (*OHLC, "volume")])
    return d.withColumns({"close": F.when((m == 3) & (F.substring("date", 6, 2) == "06"), "n/a").otherwise(F.col("close")),
                          "open": F.when((m == 4) & (F.substring("date", 6, 2) == "07"), "-1").otherwise(F.col("open")),
                          "high": F.when((m == 5) & (F.substring("date", 6, 2) == "08"), "0.01").otherwise(F.col("high"))})


@query("S10_clean_bars", SYM + """, u as (select * from sym where not (sid % 20 = 3 and month(date) = 6) and not (sid % 20 = 4 and month(date) = 7)
   and not (sid % 20 = 5 and month(date) = 8))\n""" + report("u", "ticker date", "open high low close volume"))
def clean_bars(ws):
    """Readable, complete, possible bars."""
    return src.valid_bars(src.clean_bars(_raw(ws)))[0].drop("sid")


@query("S10_dropped_bars", SYM + "\nselect count(*) n_dropped from sym where (sid % 20 = 4 and month(date) = 7) or (sid % 20 = 5 and month(date) = 8)")
def dropped_bars(ws):
    """Number of impossible bars dropped."""
    return src.valid_bars(src.clean_bars(_raw(ws)))[1]


def payloads(ws):
    """Provider payload per ticker: parallel arrays in units (a ticker has one entry per session at most)."""
    s = F.sort_array(F.collect_list(F.struct((F.datediff("date", F.lit("1970-01-01").cast("date")).cast("long") * 86400).alias("t"), *[(F.col(c) * 1000).alias(c[0]) for c in OHLC], F.col("volume").alias("v"))))
    g = ws.symbols().groupBy("ticker").agg(s.alias("r"))
    return g.select("ticker", F.to_json(F.struct(*[F.col(f"r.{c}").alias(c) for c in "tohlcv"])).alias("payload"))


@query("S11_explode_payload", SYM + ", u as (select ticker, date, open*1000 as open, high*1000 as high, low*1000 as low, close*1000 as close, volume from sym where date >= date '1999-01-01')\n"
       + report("u", "ticker date", "open high low close volume"))
def explode_payload(ws):
    """Parallel arrays to bars."""
    return src.explode_payload(payloads(ws), "1999-01-01")


@query("S12_rescale", chain("sym", "idx") + """, u as (select ticker, date, close from sym union all select ticker, date, close from idx)\n""" + report("u", "ticker date", "close"))
def rescale(ws):
    """Stocks quoted in units back to thousands, index untouched."""
    cols = BAR[:7]
    big = ws.symbols().select("ticker", "date", *[(F.col(c) * 1000).alias(c) for c in OHLC], "volume").select(*cols)
    return src.rescale_stocks(big.unionByName(ws.index().select(*cols))).select("ticker", "date", "close")


@query("S12_rescale_by_median", SYM + """, k as (select *, close*(case when sid % 2 = 0 then 1000 else 1 end) cc from sym),
m as (select ticker, median(cc) m from k group by 1), u as (select ticker, date, case when m > 1000 then cc/1000 else cc end as close from k join m using (ticker))\n""" + report("u", "ticker date", "close"))
def rescale_by_median(ws):
    """Scale guessed from the median close."""
    k = F.when(F.col("sid") % 2 == 0, 1000.0).otherwise(1.0)
    return src.rescale_by_median(ws.symbols().withColumns({c: F.col(c) * k for c in OHLC})).select("ticker", "date", "close")


@query("S13_upsert_industry", chain("ind", "sym") + """
select ticker, case when (sid % 6 = 0 and sid % 4 <> 0) then 'NEW' else industry end industry from (select distinct ticker, sid from sym) join ind using (ticker)""")
def upsert_industry(ws):
    """Last non-null industry per ticker."""
    cur = ws.industry().join(ws.symbols().select("ticker").distinct(), "ticker", "left_semi")
    new = ws.symbols().where("sid % 6 = 0").select("ticker", F.when(F.col("sid") % 4 != 0, "NEW").alias("industry"), F.datediff("date", F.lit("1990-01-01").cast("date")).alias("seq"))
    return op.upsert_dim(cur, new, seq="seq")


@query("S14_liquid_tickers", SYM + """, u as (select ticker, avg(turnover) mean_turnover from sym where date > (select max(date) from sym) - 40 group by 1 having avg(turnover) >= 80000)\n"""
       + report("u", "ticker", "mean_turnover"))
def liquid_tickers(ws):
    """Tickers worth refreshing."""
    return op.liquid_tickers(ws.symbols(), 40, 80_000.0)


# ---- order books from `orders` ----


@_stored
def order_book_path(ws: Workspace) -> str:
    """Books as JSON lines: one book per (agent, session) and block of 2000 order numbers."""
    n = ws.table("supplier").count()
    prev = ws.symbols().select("ticker", "date", F.col("close").alias("pc"))
    o = ws.table("orders").select(
        "o_orderkey", F.concat(F.lit("A"), F.col("o_custkey") % 4 + 1).alias("agent"), F.date_trunc("week", "o_orderdate").cast("date").alias("for_session"),
        (F.col("o_orderkey") % n).alias("s"), "o_orderstatus", "o_orderpriority", "o_totalprice", F.floor(F.col("o_orderkey") / 2000).alias("part"))
    o = o.withColumn("ticker", Workspace.code(F.col("s"))).withColumn("pd", F.date_sub("for_session", 7))
    o = o.join(prev.withColumnRenamed("date", "pd"), ["ticker", "pd"], "left")
    side = F.when(F.col("o_orderstatus") == "O", "BUY").when(F.col("o_orderstatus") == "F", "SELL").when(F.col("o_orderkey") % 2 == 0, "HOLD").otherwise("WATCH")
    typ = F.when(F.col("o_orderpriority").startswith("1"), "ATO").when(F.col("o_orderpriority").startswith("2"), "ATC").otherwise("LO")
    lim = F.when(typ == "LO", F.coalesce("pc", F.lit(20.0)) * (0.97 + 0.01 * (F.col("o_orderkey") % 7)))
    item = F.struct(F.col("o_orderkey").alias("_k"), side.alias("side"), F.lower("ticker").alias("ticker"), typ.alias("type"), lim.alias("limit"), (F.col("o_totalprice") * 1000).alias("value_vnd"),
                    F.when(side == "SELL", F.when(F.col("o_orderkey") % 3 == 0, "all").otherwise(((F.col("o_orderkey") % 50 + 1) * 100).cast("string"))).alias("qty"),
                    (lim * 0.95).alias("stop_loss"), (lim * 1.1).alias("take_profit"), (F.col("o_orderkey") % 40 + 1).alias("horizon_sessions"),
                    F.lit("medium").alias("confidence"), F.lit(None).cast("string").alias("condition"), F.concat(F.lit("rule "), F.col("o_orderkey")).alias("reason"), F.array(F.lit("panel")).alias("sources"))
    b = o.groupBy("agent", "for_session", "part").agg(F.sort_array(F.collect_list(item)).alias("orders"))
    hour = F.when(F.dayofyear("for_session") % 11 == 0, 3).otherwise(1)         # 10:00 or 08:00 local
    b = b.select("agent", "for_session", F.lit("evening").alias("decided_at"), (F.col("for_session").cast("timestamp") + F.make_dt_interval(hours=hour)).alias("committed_at"),
                 F.lit("flat").alias("market_view"), F.lit("small").alias("risk_plan"), F.transform("orders", lambda x: x.dropFields("_k")).alias("orders"))
    path = f"{shared_dir(ws.spark)}/{ws.spark.sparkContext.applicationId}/books-{uuid.uuid4().hex[:12]}"
    b.write.json(path, compression="gzip")
    return path


@_stored
def orders(ws: Workspace):
    return materialise(books.read_orders(ws.spark, order_book_path(ws)), "orders")


ORD = """
od0 as (select o_orderkey, 'A' || (o_custkey % 4 + 1) agent, cast(date_trunc('week', o_orderdate) as date) session, o_orderkey % (select count(*) from supplier) s,
   o_orderstatus, o_orderpriority, o_totalprice, o_orderkey // 2000 part from orders),
od1 as (select *, case when s % 50 = 49 then 'W' else '' end || lpad(upper(to_base(s, 36)), 6, '0') ticker from od0),
od2 as (select od1.*, p.close pc, case o_orderstatus when 'O' then 'BUY' when 'F' then 'SELL' else case when o_orderkey % 2 = 0 then 'HOLD' else 'WATCH' end end side,
   case substr(o_orderpriority,1,1) when '1' then 'ATO' when '2' then 'ATC' else 'LO' end type from od1 left join sym p on p.ticker = od1.ticker and p.date = od1.session - 7),
od3 as (select *, case when type = 'LO' then coalesce(pc, 20e0)*(0.97e0+0.01e0*(o_orderkey % 7)) end as lim, o_totalprice*1000 value_vnd,
   case when side = 'SELL' then case when o_orderkey % 3 = 0 then 'all' else ((o_orderkey % 50 + 1)*100)::varchar end end qty from od2),
od as (select agent, session, row_number() over (partition by agent, session, part order by o_orderkey) - 1 idx, side, ticker, type, lim, value_vnd, qty,
   lim*0.95e0 stop_loss, lim*1.1e0 take_profit, o_orderkey % 40 + 1 horizon_sessions,
   session::timestamp + to_hours(case when dayofyear(session) % 11 = 0 then 3 else 1 end) committed_at, o_orderkey from od3)"""


@query("S15_order_books", chain("sym") + "," + ORD + "\n" + report("(select *, lim as limit_price from od)", "agent session side ticker type qty", "limit_price value_vnd stop_loss take_profit", "idx horizon_sessions"))
def order_books(ws):
    """Nested JSON books to one row per order."""
    return books.read_orders(ws.spark, order_book_path(ws)).select("agent", "session", "side", "ticker", "type", "qty", F.col("limit").alias("limit_price"),
                                                                  "value_vnd", "stop_loss", "take_profit", "idx", "horizon_sessions")


@query("S16_nonfinite_to_null", SYM + ", u as (select ticker, date, case when sid % 7 not in (2, 3) then close end as close, volume from sym)\n" + report("u", "ticker date", "close volume"))
def nonfinite(ws):
    """NaN and infinity published as null."""
    m = F.col("sid") % 7
    d = ws.symbols().withColumn("close", F.when(m == 2, F.lit(float("nan"))).when(m == 3, F.lit(float("inf"))).otherwise(F.col("close")))
    return clean_nonfinite(d).select("ticker", "date", "close", "volume")


@query("S17_publish_slice", livelog.LOG + """,
r15 as (select distinct data_date from st order by 1 desc limit 15)
select data_date, ticker, status from (select *, case when data_date < date '2001-05-01' and settled_on is not null then date '2001-09-03' else settled_on end so from st)
where data_date in (select data_date from r15) or so = date '2001-09-03'""")
def publish_slice(ws):
    """Newest fifteen dates plus rows settled on the run date."""
    early = F.col("data_date") < F.lit("2001-05-01").cast("date")
    log = livelog.settled(ws).withColumn("settled_on", F.when(early & F.col("settled_on").isNotNull(), F.lit("2001-09-03").cast("date")).otherwise(F.col("settled_on")))
    return sinks.publish_slice(log, "2001-09-03").select("data_date", "ticker", "status")


@query("S18_replace_snapshot", SYM + """, l as (select max(date) m from sym)
select ticker, date data_date, round(close, 6) as close from sym, l where date = m""")
def replace_snapshot(ws):
    """Two daily snapshots written, the second replaces its partition only; readers see the newest date."""
    path = f"{shared_dir(ws.spark)}/{ws.spark.sparkContext.applicationId}/snap-{uuid.uuid4().hex[:12]}"
    d = ws.symbols().select("ticker", F.col("date").alias("data_date"), "close")
    sinks.replace_snapshot(d.withColumn("close", F.lit(0.0)), path)
    last = d.where(F.col("data_date") == d.select(F.max("data_date")).scalar())
    sinks.replace_snapshot(last, path)
    return sinks.drop_older(ws.spark.read.schema("ticker string, close double, data_date date").parquet(path)).select("ticker", "data_date", "close")


@query("S19_merge_columns", livelog.SIG + """,
dt as (select data_date, ticker, regime from sg where data_date < date '2001-07-01'), oo as (select data_date, ticker, status, net from sg where data_date >= date '2001-06-01'),
mc as (select data_date, ticker, regime, status, net from dt full outer join oo using (data_date, ticker))\n""" + report("mc", "data_date ticker regime status", "net"))
def merge_columns(ws):
    """Detail and outcome columns written separately under one key."""
    s = livelog.signals(ws)
    return sinks.merge_columns(s.where("data_date < date '2001-07-01'").select("data_date", "ticker", "regime"),
                               s.where("data_date >= date '2001-06-01'").select("data_date", "ticker", "status", "net"))


@query("S20_scores_daily", chain("scored") + "\n" + report("(select *, rank() over (order by p_up_5 desc) rank_all from scored where date = (select max(date) from scored))",
                                                          "date ticker industry value_mode value_top30 regime exch exch_src", "close p_up_5 p_lr value_score trend_score atr14_pct liq20",
                                                          "rank_all near_ceiling near_floor"))
def scores_daily(ws):
    """Score table of the last date."""
    return sinks.scores_daily(ws.scored_plan(*[c for c in sinks.SCORE_COLUMNS if c != "rank_all"]), ws.cfg)


@query("S21_news_items", r"""with it as (select regexp_extract(url, '^https?://([^/]+)', 1) feed, page_id seq, ts published, html body from pages left join events on event_id = page_id
   where coalesce(timestamp '2024-01-02 18:00:00' - ts <= interval 36 hour, true)),
k as (select * from it qualify row_number() over (partition by feed order by seq) <= 25),
t as (select feed, seq, published, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(body, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''),
   '&nbsp;', ' '), '&amp;', '&'), '<[^>]+>', ' ', 'g'), '[\s\x{0B}\x{A0}]+', ' ', 'g')) txt from k)
select feed, seq, published, substr(txt, 1, 220) summary, length(txt) n_chars from t""")
def news_items(ws):
    """Recent items without tags, with a short summary."""
    p = ws.table("pages").join(ws.table("events").select(F.col("event_id").alias("page_id"), F.col("ts").alias("published")), "page_id", "left")
    d = p.select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("feed"), F.col("page_id").alias("seq"), "published", F.col("html").alias("body"))
    return src.clean_items(d, "2024-01-02 18:00:00")
