"""Language of web pages by Bayesian evidence fusion.

Text: byte-trigram profiles of each language, counted over all labelled documents; a page's visible text gives a
log-likelihood per trigram for each language, tempered because neighbouring trigrams aren't independent. Then, by
grouped aggregation over all pages: how the declared markup language goes with the text's language (smoothed
confusion counts), and how often each language occurs on a host, under its address suffix and overall (each level shrunk
toward the next by `STRENGTH` pages). The suffix speaks as the level above the host, once. A page's own text is left out
of the sums that make its prior. The posterior multiplies likelihood, declaration and prior.

Nulls: a null page or URL is empty; it has no declared language, its host is "" and its text says nothing, so the
priors decide; a null id is kept. Documents of null language or text teach nothing. All languages of the documents are
told apart (a row of 128 kB each in the model, so a thousand are 131 MB); without any, the language is null. Ties go
to the first by name. Repeated rows each get the same answer; an empty table gives no rows. A very long text or page is
cut into trigrams alone. Other columns are not read, so their names cannot clash."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_map, buffer_of, slices, small, staged
from .warc import plain_text

BITS, STRENGTH, TEMPER = 15, 20.0, 0.2
#: Languages whose counts the driver fetches at a time.
BLOCK = 32
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32


def trigrams(buf: np.ndarray) -> np.ndarray:
    """Bucket of each byte trigram (letters in lower case)."""
    x = _LOWER[buf]
    key = (x[:-2] << 16 | x[1:-1] << 8 | x[2:]) if len(x) > 2 else np.zeros(0, np.uint32)
    return (key * np.uint32(2654435769)) >> np.uint32(32 - BITS)


def profiles(docs: DataFrame) -> DataFrame:
    """docs (text, lang) -> lang, bucket, n: trigram counts over all rows, summed in each task first."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for part in slices(batches):
            buf, at = buffer_of(part.column("text"))
            lang = np.array(part.column("lang").to_pylist(), object)
            for name in set(lang.tolist()):
                own = np.concatenate([trigrams(buf[a:b]) for a, b in zip(at[:-1][lang == name].tolist(), at[1:][lang == name].tolist(), strict=True)])
                sums.setdefault(name, np.zeros(1 << BITS, np.int64))
                sums[name] += np.bincount(own, minlength=1 << BITS)
        for name, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at, pa.int32()), pa.array(n[at])], names=["lang", "bucket", "n"])

    return arrow_map(docs.where("lang is not null and text is not null"), run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _likelihoods(pages: DataFrame, names: list[str], logp: np.ndarray) -> DataFrame:
    """Adds what the text says: ll (tempered, by language), and the declared language."""
    model = pages.sparkSession.sparkContext.broadcast(logp)

    def run(batches):
        table = model.value
        for part in slices(batches, "html", 4 << 20):
            out = []
            for page in part.column("html").to_pylist():
                t = trigrams(np.frombuffer(plain_text(page or "").encode(), np.uint8))
                out.append((TEMPER * table[:, t].sum(axis=1, dtype=np.float64)).tolist())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("page_id", "host", "suffix", "declared")), pa.array(out, pa.list_(pa.float64()))], names=["page_id", "host", "suffix", "declared", "ll"])

    return arrow_map(pages, run, "page_id long, host string, suffix string, declared string, ll array<double>")


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """page_id, host, declared, text_lang (by text alone), lang, confidence (posterior of lang)."""
    learned = staged(profiles(docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))))
    names = sorted(r["lang"] for r in learned.select("lang").distinct().collect())
    pooled = np.full(1 << BITS, 0.5)
    for r in learned.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # 2**BITS rows
        pooled[r["bucket"]] += r["n"]
    logp = np.zeros((len(names), 1 << BITS), np.float32)
    for k in range(0, len(names), BLOCK):  # BLOCK * 2**BITS rows at a time
        part = learned.where(F.col("lang").isin(names[k : k + BLOCK])).toArrow()
        counts = np.zeros((len(names[k : k + BLOCK]), 1 << BITS))
        row = np.searchsorted(names[k : k + BLOCK], np.array(part.column("lang").to_pylist(), str)) if part.num_rows else []
        counts[row, part.column("bucket").to_numpy()] = part.column("n").to_numpy()
        smooth = counts + 1000 * pooled / pooled.sum()
        logp[k : k + BLOCK] = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    page = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    declared = F.lower(F.regexp_extract(page, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})", 1))
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), F.substring_index(host, ".", -1).alias("suffix"), declared.alias("declared"), page.alias("html"))
    scored = staged(_likelihoods(source, names, logp))
    if not names:
        return scored.select("page_id", "host", "declared", F.lit(None).cast("string").alias("text_lang"), F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"))
    soft = F.expr("transform(ll, x -> exp(x - array_max(ll)))")
    share = "transform(soft, x -> x / aggregate(soft, 0D, (a, b) -> a + b))"
    scored = scored.withColumn("soft", soft).withColumn("soft", F.expr(share))
    soft = scored
    mean = lambda by: soft.groupBy(*by).agg(*(F.sum(F.col("soft")[i]).alias(f"s{i}") for i in range(len(names))))
    row = F.array(*(F.col(f"s{i}") for i in range(len(names))))
    cells = staged(mean(["host", "suffix", "declared"]))  # sums by host; the rest are sums of these
    add = lambda by: cells.groupBy(*by).agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(len(names))))
    total = np.array([float(x or 0) for x in add([]).first()]) + 1
    base = total / total.sum()

    def conditional(by: str) -> DataFrame:
        """log P(value | language), one more value standing for all unseen ones."""
        one = F.array(*(F.log((F.col(f"s{i}") + 0.5) / F.lit(float(total[i] + 0.5))) for i in range(len(names))))
        return staged(add([by]).select(by, one.alias(f"{by}_l")))

    suffixes = staged(add(["suffix"]).select("suffix", row.alias("of_suffix")))
    hosts = staged(add(["host"]).select("host", row.alias("of_host")))
    fused = scored.join(small(hosts), "host").join(small(suffixes), "suffix").join(small(conditional("declared")), "declared")
    # without the page itself: the suffix shrunk toward all pages, the host toward its suffix
    overall = F.array(*map(F.lit, base.tolist()))
    shrunk = lambda c, up: f"transform(arrays_zip({c}, soft, {up}), x -> (greatest(x.{c} - x.soft, 0D) + {STRENGTH}D * x.{up}) / (greatest(aggregate({c}, 0D, (a, b) -> a + b) - 1, 0D) + {STRENGTH}D))"
    fused = fused.withColumn("overall", overall).withColumn("up", F.expr(shrunk("of_suffix", "overall"))).withColumn("prior", F.expr(shrunk("of_host", "up")))
    # an absent declaration says nothing
    says = "if(declared = '', 0D, x.declared_l)"
    post = F.expr(f"transform(arrays_zip(ll, prior, declared_l), x -> x.ll + ln(x.prior) + {says})")
    fused = fused.withColumn("post", post).withColumn("top", F.array_max("post"))
    label = F.array(*map(F.lit, names))
    best = lambda c: F.element_at(label, F.array_position(c, F.array_max(c)).cast("int"))
    confidence = 1 / F.expr("aggregate(post, 0D, (a, x) -> a + exp(x - top))")
    text_lang = F.when(F.array_max("ll") < 0, best(F.col("ll")))
    return fused.select("page_id", "host", "declared", text_lang.alias("text_lang"), best(F.col("post")).alias("lang"), confidence.alias("confidence"))


def op6_language_fusion(spark, sf_dir: str) -> DataFrame:
    """Query: the language of every page, with profiles from all documents."""
    out = identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.withColumn("confidence", F.round("confidence", 6))
