"""What a run writes. Tables stay Parquet; these render the exchange formats."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.text import wrap

#: The leading columns of the long presence matrix.
MATRIX_COLUMNS = (
    "Gene", "Non-unique Gene name", "Annotation", "No. isolates", "No. sequences", "Avg sequences per isolate", "Genome Fragment", "Order within Fragment",
    "Accessory Fragment", "Accessory Order with Fragment", "QC", "Min group size nuc", "Max group size nuc", "Avg group size nuc",
)
#: Columns of the gene table.
GENE_COLUMNS = ("gff_file", "scaffold_name", "clustering_id", "annotation_id", "prot_sequence", "dna_sequence", "gene_name", "description")


def fasta_line(seq_id: Column, seq: Column, description: Column | None = None, width: int = 60) -> Column:
    """A record: the id, its description unless that repeats it, and lines of ``width``."""
    title = seq_id
    if description is not None:
        d = F.coalesce(description, F.lit(""))
        title = F.when((d == "") | (d == seq_id), seq_id).when(d.startswith(F.concat(seq_id, F.lit(" "))), d).otherwise(F.concat_ws(" ", seq_id, d))
    return F.concat(F.lit(">"), title, F.lit("\n"), wrap(seq, width))


def write_fasta(rows: DataFrame, path: str, seq_id: str, seq: str, description: str | None = None, partition_by: str | None = None) -> None:
    """One text part per task, or one folder per value of ``partition_by``."""
    line = fasta_line(F.col(seq_id), F.col(seq), F.col(description) if description else None).alias("value")
    out = rows.select(*([partition_by] if partition_by else []), line).write.mode("overwrite")
    (out.partitionBy(partition_by) if partition_by else out).text(path)


def write_csv(rows: DataFrame, path: str, sep: str = ",") -> None:
    """Unquoted, as fields have no separators in them."""
    rows.write.mode("overwrite").option("header", True).option("sep", sep).option("quote", "").option("emptyValue", "").csv(path)


def gff_line(*cols: Column) -> Column:
    return F.concat_ws("\t", *(F.coalesce(c.cast("string"), F.lit(".")) for c in cols))


def escape_xml(s: Column) -> Column:
    """Text as graph files have it: ampersand, quotes and other than printable ASCII as entities."""
    s = F.replace(F.replace(s, F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&#34;"))
    chars = F.transform(F.split(s, ""), lambda c: F.when(c.rlike(r"[^\x20-\x7E]"), F.concat(F.lit("&#"), F.ascii(c).cast("string"), F.lit(";"))).otherwise(c))
    return F.array_join(chars, "")


def _gml_value(c: Column, kind: str) -> Column:
    if kind in ("int", "bigint"):
        n = c.cast("long")
        return F.when(n.between(-(2**31), 2**31 - 1), n.cast("string")).otherwise(F.concat(F.lit('"'), n.cast("string"), F.lit('"')))
    if kind == "boolean":
        return F.when(c, "1").otherwise("0")
    if kind == "double":
        return c.cast("string")
    return F.concat(F.lit('"'), escape_xml(c.cast("string")), F.lit('"'))


def _gml_item(name: str, kind: str):
    return lambda x: F.concat(F.lit(f"    {name} "), _gml_value(x, kind))


def _gml_fields(df: DataFrame, skip: set[str]) -> list[Column]:
    out = []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        kind = f.dataType.simpleString()
        if kind.startswith("array"):
            items = F.transform(F.col(f.name), _gml_item(f.name, kind[6:-1]))
            alone = F.when(F.size(f.name) == 1, F.concat(F.lit(f'    {f.name} "_networkx_list_start"\n'), F.array_join(items, "\n"))).otherwise(F.array_join(items, "\n"))
            out.append(F.when(F.size(f.name) == 0, F.lit(None)).otherwise(alone))
        else:
            out.append(F.when(F.col(f.name).isNotNull(), F.concat(F.lit(f"    {f.name} "), _gml_value(F.col(f.name), kind))))
    return out


def gml(nodes: DataFrame, edges: DataFrame, ord_: str = "ord", node: str = "node") -> DataFrame:
    """(k, n, value): the blocks of a graph file in order; write them sorted by (k, n)."""
    n = nodes.select(F.lit(1).alias("k"), F.col(ord_).cast("long").alias("n"), F.concat(F.lit("  node [\n    id "), F.col(ord_).cast("string"), F.lit("\n    label \""), F.col(node).cast("string"), F.lit("\"\n"), F.concat_ws("\n", *_gml_fields(nodes, {ord_, node})), F.lit("\n  ]")).alias("value"))
    e = edges.select(F.lit(2).alias("k"), F.col("source").cast("long").alias("n"), F.concat(F.lit("  edge [\n    source "), F.col("source").cast("string"), F.lit("\n    target "), F.col("target").cast("string"), F.lit("\n"), F.concat_ws("\n", *_gml_fields(edges, {"source", "target"})), F.lit("\n  ]")).alias("value"))
    ends = nodes.sparkSession.createDataFrame([(0, 0, "graph ["), (3, 0, "]")], "k int, n long, value string")
    return ends.unionByName(n).unionByName(e)


def write_gml(nodes: DataFrame, edges: DataFrame, path: str, **names: str) -> None:
    blocks = gml(nodes, edges, **names)
    blocks.repartitionByRange(8, "k", "n").sortWithinPartitions("k", "n").select("value").write.mode("overwrite").text(path)


def write_manifest(spark, path: str, settings: dict, resume: bool = False) -> dict:
    """A run's settings as JSON. An existing one is an error, or must agree when a run is taken up again."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    text = json.dumps(settings, sort_keys=True)
    if fs.exists(place):
        if not resume:
            raise FileExistsError(f"{path}: a run is there already")
        old = json.loads(spark.read.text(path, wholetext=True).first()[0])
        wrong = {k: (old.get(k), v) for k, v in settings.items() if old.get(k) != v}
        if wrong:
            raise ValueError(f"settings differ: {wrong}")
        return old
    out = fs.create(place, False)
    out.write(bytearray(text.encode()))
    out.close()
    return settings
