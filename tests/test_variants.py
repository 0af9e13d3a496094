"""Variants backed by evidence: id choice, gates, hot loci; what ingests give, the store takes."""

import pytest
from pyspark.sql import functions as F

from kgloom.functions.records import first_scalar, variant_id
from kgloom.operators import ingest as I
from kgloom.operators import variants as V
from kgloom.operators.hot import split_join
from kgloom.sources.store import KGRoot


def ids(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(variant_id(df).alias("v")).collect()]


def test_variant_id_takes_the_first_usable_field(spark):
    flat = "variantId string, variantRsId string, rsIds array<string>, tagVariantId string"
    assert ids(spark, [(" 1_2_A_C ", "rs1", None, None), ("nan", " rs1", None, None), (None, "", [None, " ", "nan", "rs3"], "t"), (None, None, [], "t"), (None, None, None, "")], flat) == ["1_2_A_C", "rs1", "rs3", "t", None]
    assert ids(spark, [([("", "rs9")],), ([],)], "variantId array<struct<variantId:string,rsId:string>>") == ["rs9", None]
    assert ids(spark, [("x", [("g", None), ("g", "rs7")])], "targetId string, locus array<struct<targetId:string,leadVariantId:string>>") == ["rs7"]
    assert ids(spark, [("g",)], "targetId string") == [None]


def test_first_scalar_of_numbers(spark):
    df = spark.createDataFrame([([None, 5],)], "a array<int>")
    assert df.select(first_scalar(F.col("a"), df.schema["a"].dataType)).first()[0] == "5"


EVIDENCE = "dataset string, diseaseId string, datatypeId string, datasourceId string, score double, studyLocusId string, resourceScore double, variantId string"


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_locus_gates(spark):
    said = [
        (V.LOCUS_DATASET, "MONDO_1", None, None, 0.0, "L1", 0.9, None),
        (V.LOCUS_DATASET, "MONDO_2", "eva", "other", 1.0, "L1", None, None),  # another source
        (V.LOCUS_DATASET, None, "eva", None, 1.0, "L1", None, None),
        ("evidence_eva", "MONDO_3", "eva", "eva", 1.0, None, None, "rs5"),
        ("evidence_eva", "MONDO_4", "eva", "eva", 1.0, None, None, None),  # no variant: a stub only
        ("evidence_eva", "MONDO_5", "literature", "x", 1.0, None, None, "rs5"),  # another datatype
    ]
    credible = spark.createDataFrame([("L1", "rs1", -8), ("L1", "rs2", -7), ("L1", "1_1_A_C", None), ("L2", "rs3", -50), (None, "rs4", -50)], "studyLocusId string, variantId string, pValueExponent int")
    l2g = spark.createDataFrame([("L1", "ENSG1", 0.75), ("L1", "ENSG2", 0.74), ("L2", "ENSG3", 0.9), ("L2", "ENSG4", None)], "studyLocusId string, geneId string, score double")
    found = V.evidence_backed_variants(spark.createDataFrame(said, EVIDENCE), credible, l2g, spark.createDataFrame([("MONDO_1",)], "id string"), spark.createDataFrame([("ENSG1",)], "id string"))
    assert rows_of(found["mutation_associated_disease"], "x_id", "y_id", "source", "datatype", "score") == [
        ("1_1_A_C", "MONDO:1", "OpenTargets/ot_genetics_portal", "gwas_credible_sets", 0.9), ("rs1", "MONDO:1", "OpenTargets/ot_genetics_portal", "gwas_credible_sets", 0.9), ("rs5", "MONDO:3", "OpenTargets/eva", "eva", 1.0),
    ]
    assert rows_of(found["mutation_associated_gene"], "x_id", "y_id") == [("1_1_A_C", "ENSG1"), ("rs1", "ENSG1"), ("rs3", "ENSG3")]
    assert rows_of(found["disease"], "id", "mondo_id") == [("MONDO:3", "MONDO:3"), ("MONDO:4", "MONDO:4")]
    assert rows_of(found["gene"], "id") == [("ENSG3",)]
    assert rows_of(found["mutation"], "id", "clinvar_id", "gnomad_id")[0] == ("1_1_A_C", None, "1_1_A_C")


def test_a_locus_of_100000_variants(spark):
    credible = spark.range(100_000).select(F.lit("L").alias("studyLocusId"), F.concat(F.lit("rs"), "id").alias("variantId")).union(spark.createDataFrame([("M", "rs1")]))
    said = spark.createDataFrame([(V.LOCUS_DATASET, f"EFO_{k}", "eva", None, 1.0, locus, None, None) for k in range(3) for locus in "LM"], EVIDENCE)
    found = V.locus_variants(credible, said, rows=10_000)
    assert found.count() == found.distinct().count() == 300_003 and found.select("v").distinct().count() == 100_000
    left = credible.select(F.col("studyLocusId").alias("locus"), "variantId")
    blocks = split_join(left, said.select(F.col("studyLocusId").alias("locus"), "diseaseId"), ["locus"], 10_000)
    plan = blocks._jdf.queryExecution().optimizedPlan().toString()
    assert "_i#" in plan and blocks.count() == 300_003


def test_split_join_of_both_sides(spark):
    a = spark.range(50).select((F.col("id") % 2).alias("k"), F.col("id").alias("a"))
    b = spark.range(70).select((F.col("id") % 3).alias("k"), F.col("id").alias("b"))
    assert sorted(map(tuple, split_join(a, b, ["k"], 4).collect())) == sorted(map(tuple, a.join(b, "k").collect()))


def sources(spark):
    """Each ingest over a record or two."""
    ev = spark.createDataFrame([("evidence_x", "ENSG1", "MONDO_1", "reactome", "r", 0.5, [("R-HSA-1", None), ("R-HSA-2", "A path")], None, None), ("evidence_x", "R-HSA-3", "MONDO_1", "reactome", "r", 0.5, [], "R-HSA-1", "A reaction")], "dataset string, targetId string, diseaseId string, datatypeId string, datasourceId string, score double, pathways array<struct<id:string,name:string>>, reactionId string, reactionName string")
    variants = spark.createDataFrame([("v1", "h", ["rs1"], [(True, "ENSG1", "ENST1", "A1B", ["P1"])])], "variantId string, hgvsId string, rsIds array<string>, transcriptConsequences array<struct<isEnsemblCanonical:boolean,targetId:string,transcriptId:string,aminoAcidChange:string,uniprotAccessions:array<string>>>")
    proteins = spark.createDataFrame([("ENSP1", "P1", "ENSG1")], "id string, uniprot_id string, ensembl_gene_id string")
    yield I.evidence(ev)
    yield I.disease_phenotypes(spark.createDataFrame([("MONDO_1", "HP_1", [("TAS", False)])], "disease string, phenotype string, evidence array<struct<evidenceType:string,qualifierNot:boolean>>"))
    yield I.biosamples(spark.createDataFrame([("CL_1", "cell"), ("UBERON_1", "skin")], "biosampleId string, biosampleName string"))
    yield I.variants(variants, proteins)
    yield I.pharmacogenomics(spark.createDataFrame([("v1", None, "1A", "efficacy", None, [("CHEMBL1",)])], "variantId string, variantRsId string, evidenceLevel string, pgxCategory string, datasourceId string, drugs array<struct<drugId:string>>"))
    yield I.expression(spark.createDataFrame([("ENSG1", [("CL_1", (1.0, 2))])], "id string, tissues array<struct<efo_code:string,rna:struct<value:double,level:int>>>"), proteins)
    yield I.enhancers(spark.createDataFrame([("EH1", "ENSG1", "CL_1", "1", 1, 2, 0.5, None)], "intervalId string, geneId string, biosampleId string, chromosome string, start int, end int, score double, datasourceId string"))
    yield I.gene_ontology(spark.createDataFrame([("GO_1", "a term")], "id string, label string"), spark.createDataFrame([("ENSG1", [("GO:1", "IEA", "F")])], "id string, go array<struct<id:string,evidence:string,aspect:string>>"))
    yield I.diseases(spark.createDataFrame([("MONDO_1", "ill", "", ["OMIM:1"], ["MONDO_2"])], "id string, name string, description string, dbXRefs array<string>, parents array<string>"))
    yield I.molecules(spark.createDataFrame([("CHEMBL1", "m", "k", "C", [("drugbank", ["DB1"])])], "id string, name string, inchiKey string, canonicalSmiles string, crossReferences array<struct<source:string,ids:array<string>>>"))
    yield V.evidence_backed_variants(ev.withColumn("variantId", F.lit("rs1")).withColumn("datatypeId", F.lit("eva")))


NODES = ("gene", "transcript", "protein", "disease", "cell_type", "tissue", "molecule", "phenotype", "pathway", "mutation", "cell_line", "enhancer")


def test_the_store_takes_what_ingests_give(spark, tmp_path):
    root, seen = KGRoot(spark, str(tmp_path)), set()
    for found in sources(spark):
        for name, df in found.items():
            if name in NODES:
                root.save_nodes(name, df)
                seen.add(name)
            elif name.startswith("evidence/"):
                root.write_evidence(name.removeprefix("evidence/"), df, append=True)
            elif {"x_type", "display_relation"} <= set(df.columns):
                root.write_edges(name, df, append=True)
    assert seen >= {"gene", "disease", "cell_type", "tissue", "molecule", "phenotype", "pathway", "mutation", "enhancer"}
    assert rows_of(root.read("nodes", "pathway").where("source = 'OpenTargets/evidence'"), "id", "name") == [("R-HSA-1", "A reaction"), ("R-HSA-2", "A path")]
    assert {r["release"] for r in root.read("evidence", "disease_involves_pathway").collect()} == {"26.03"}
    with pytest.raises(ValueError):
        root.write_nodes("gene", spark.createDataFrame([("ENSG1",)], "id string"))
    assert dict(root.read("edges", "disease_associated_gene", ["x_id", "is_essential", "gene_effect"]).dtypes) == {"x_id": "string", "is_essential": "boolean", "gene_effect": "double"}
