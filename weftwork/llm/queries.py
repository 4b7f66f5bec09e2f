"""The thin queries over the whole tables, one for each operator, and their SQL where SQL can state them."""

from pyspark.sql import functions as F

from weftwork.llm import sql
from weftwork.llm.common import table
from weftwork.session import shared_folder


def op1_main_text(spark, sf_dir):
    from weftwork.llm.wrappers import main_texts

    return main_texts(table(spark, sf_dir, "pages"))


def op2_importance(spark, sf_dir):
    from weftwork.llm.resample import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_neighbours(spark, sf_dir):
    from weftwork.llm.neighbours import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op4_decontamination(spark, sf_dir):
    from weftwork.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_packing(spark, sf_dir):
    from weftwork.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op6_token_files(spark, sf_dir):
    from weftwork.llm.tokenfile import read_token_files, write_token_files

    path = shared_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return read_token_files(spark, path)


def op7_line_dedup(spark, sf_dir):
    from weftwork.llm.linededup import without_repeated_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = without_repeated_lines(docs)
    return cleaned.select("doc_id", "lines_dropped", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op8_minhash(spark, sf_dir):
    from weftwork.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark, sf_dir):
    from weftwork.llm.suffixdedup import without_repeats

    return without_repeats(table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    from weftwork.llm.toxicity import learn, toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, learn(docs, table(spark, sf_dir, "labels")))


def op11_hard_negatives(spark, sf_dir):
    from weftwork.llm.negatives import hard_negatives

    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark, sf_dir):
    from weftwork.llm.merkle import folded, manifest, proof_digest

    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    proofs = manifest(table(spark, sf_dir, "documents"), {"text": F.when(tampered, lower).otherwise(F.col("text"))})
    proofs = proofs.withColumn("folded_root", folded(F.col("found_leaf"), F.col("proof")))
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def op13_secret_scan(spark, sf_dir):
    from weftwork.llm.ledger import findings, kind_count, span_text

    found = findings(table(spark, sf_dir, "documents"), shared_folder(spark, "ledger"), ["doc_id"])
    counts = [kind_count(F.col("spans"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("spans")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


QUERIES = {q.__name__: q for q in (op1_main_text, op2_importance, op3_neighbours, op4_decontamination, op5_packing, op6_token_files, op7_line_dedup, op8_minhash, op9_suffix_dedup, op10_toxicity, op11_hard_negatives, op12_merkle_manifest, op13_secret_scan)}

SQL: dict[str, str] = {
    "op11_hard_negatives": sql.HARD_NEGATIVES,
    "op12_merkle_manifest": sql.merkle_manifest(),
    "op13_secret_scan": sql.secret_scan(),
}
