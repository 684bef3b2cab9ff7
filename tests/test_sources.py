import pytest

from helixframe.sources import readers, sinks


@pytest.fixture
def write(tmp_path):
    def put(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(path)

    return put


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_tagged_files(spark, write):
    write("run/s1/depth.tsv", "1\t5\n2\t6\n")
    write("run/s2/depth.tsv", "1\t7\n")
    path = write("run/s3/depth.tsv", "").replace("s3", "*")
    assert rows(readers.tagged_tsv(spark, path, "chr string, n long", r"/run/([^/]+)/", suffix="_norm")) == [("1", 5, "s1_norm"), ("1", 7, "s2_norm"), ("2", 6, "s1_norm")]


def test_dictionary_and_regions(spark, write):
    path = write("g.dict", "@HD\tVN:1.6\n@SQ\tSN:chr1\tLN:248956422\tM5:x\n@SQ\tSN:MT\tLN:16569\n")
    assert rows(readers.sequence_dictionary(spark, path)) == [("MT", 16569, 2), ("chr1", 248956422, 1)]
    path = write("p.bed", "1\t10\t20\tgene\textra\n1\t30\t40\n")
    assert rows(readers.region_bed(spark, path).drop("ordinal")) == [("1", 10, 20, "gene"), ("1", 30, 40, "reg_1_30_40")]


def test_depth_alleles_bands_gc(spark, write):
    path = write("s9/cov.tsv", "1\t10\t20\tname\t55\t10\t10\t1.0\n1\t30\t40\t66\t10\t10\t1.0\n")
    assert rows(readers.region_coverage(spark, path, "/([^/]+)/cov")) == [("s9", "1", 10, 20, 55), ("s9", "1", 30, 40, 66)]
    path = write("s9/snp.tsv", "1\t5\t1\t2\t3\t4\t10\n1\t6\t0\t0\t0\t0\t0\n")
    assert rows(readers.allele_counts(spark, path, "/([^/]+)/snp")) == [("1", 5, 1, 2, 3, 4, 10, "s9")]
    path = write("bands.txt", "1\t0\t9\tp1\tgneg\n1\t10\t19\tp2\tacen\n")
    assert rows(readers.cytobands(spark, path)) == [("1", 0, 9, "gneg"), ("1", 10, 19, "acen")]
    path = write("gc.tsv", "1\t0\t0.4\t0.9\n1\t10\t0.5\t0.2\n")
    assert rows(readers.gc_profile(spark, path)) == [("1", 0, 0.4, 0.9)]
    path = write("snps.tsv", "1\t5\tA\tG\t0.5\n")
    assert rows(readers.panel_snps(spark, path))[0][-1] == 0.5
    path = write("nuc.tsv", "#1_usercol\t2_usercol\t3_usercol\t4_pct_at\t5_pct_gc\n1\t0\t9\t0.6\t0.4\n1\t10\t19\t0\t0\n")
    assert rows(readers.nucleotide_table(spark, path)) == [("1", 0, 0.4, 1.0), ("1", 10, -1.0, 0.0)]


def test_segments_and_variants(spark, write):
    body = "\t".join(["1", "10", "20", "5", "3", "x", "0.25", "x", "x", "0.5"])
    path = write("a.seg", f"@HD\n@RG\tID:x\tSM:tumour1\nCONTIG\tSTART\n{body}\n")
    assert rows(readers.copy_ratio_segments(spark, path)) == [("1", 10, 20, 5, 3, 0.25, 0.5, "tumour1")]
    path = write("a.cns", "chromosome\tstart\tend\tgene\tlog2\tbaf\tdepth\tprobes\n1\t1\t2\tg\t0.5\t\t30\t7\n")
    assert rows(readers.copy_number_segments(spark, path)) == [("1", 1, 2, 0.5, None, 30.0, 7)]
    values = [str(i) for i in range(36)]
    path = write("v.tsv", "\t".join(values) + "\nWarning: R_HOME ignored\n")
    got = readers.small_variants(spark, path).collect()
    assert len(got) == 1 and got[0]["start"] == 3 and got[0]["ampflag"] is None


def test_insert_size(spark, write):
    header = ["MEDIAN_INSERT_SIZE", "MEAN_INSERT_SIZE", *[f"c{i}" for i in range(21)]]
    path = write("m.txt", "## METRICS\n" + "\t".join(header) + "\n" + "\t".join(["199", "200", *["0"] * 21]) + "\n\nhist\t1\n")
    assert [r["mean_insert_size"] for r in readers.insert_size(spark, path).collect()] == ["200"]
    none = write("none.txt", "a\tb\n")
    assert readers.insert_size(spark, none, strict=False).count() == 0
    with pytest.raises(Exception, match="no MEAN_INSERT_SIZE"):
        readers.insert_size(spark, none).collect()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", 100_000_000, "s1"), ("2", 5, "s2")], "chr string, start long, sample string")
    sinks.write_bed(df.select("chr", "start"), str(tmp_path / "bed"))
    assert {r["value"] for r in spark.read.text(str(tmp_path / "bed")).collect()} == {"1\t100000000", "2\t5"}
    sinks.append_cohort(df, str(tmp_path / "cohort"))
    # A rerun replaces its samples and leaves the others.
    sinks.append_cohort(df.where("sample = 's1'"), str(tmp_path / "cohort"))
    assert rows(readers.cohort_table(spark, str(tmp_path / "cohort")).select("chr", "sample")) == [("1", "s1"), ("2", "s2")]
    sinks.write_by_sample(df, str(tmp_path / "by"))
    assert (tmp_path / "by" / "sample=s1").is_dir()
    lines = spark.createDataFrame([("1\t20\tTYPE=DEL",), ("1\t3\tTYPE=SNV",)], "value string")
    assert sinks.drop_typed(lines).count() == 1
    sinks.write_vcf(lines, "s1", str(tmp_path / "vcf"))
    assert spark.read.text(str(tmp_path / "vcf" / "header")).first()["value"].startswith("##fileformat=VCFv4.2")
    assert spark.read.text(str(tmp_path / "vcf" / "data")).count() == 2
    names = ["chr10", "2", "X", "chr1"]
    sinks.write_vcf(spark.createDataFrame([(f"{n}\t{p}\tx",) for n in names for p in (30, 4)], "value string"), "s1", str(tmp_path / "sorted"))
    written = [line for part in sorted((tmp_path / "sorted" / "data").glob("part-*")) for line in part.read_text().splitlines()]
    assert [tuple(line.split("\t")[:2]) for line in written] == [(n, p) for n in ("chr1", "2", "chr10", "X") for p in ("4", "30")]


def test_structural_calls_of_vcf_files(spark, write):
    head = "##fileformat=VCFv4.1\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tt\tn\n"
    body = "1\t100\ta\tN\t<DEL>\t.\tPASS\tSVTYPE=DEL;END=250;IMPRECISE;X=a=b\tGT:DP\t0/1:9\t0/0\n1\t300\tb\tN\t<DUP:TANDEM>\t7.5\tlow\tSVLEN=-50\tGT\t0/1\t0/0\n2\t9\tc\tN\tN[3:7[\t.\tPASS\tSVTYPE=BND\n"
    records = readers.vcf(spark, write("calls.vcf", head + body))
    first = records.where("id = 'a'").first()
    assert first["info"] == {"SVTYPE": "DEL", "END": "250", "IMPRECISE": "", "X": "a"} or first["info"]["X"] == "a=b"
    assert first["sample_values"][0] == {"GT": "0/1", "DP": "9"} and first["sample_values"][1]["GT"] == "0/0" and records.where("id = 'b'").first()["qual"] == 7.5
    assert rows(readers.structural_calls(records)) == [("a", "1", 100, 250, "DEL", "PASS"), ("b", "1", 300, 350, "DUP", "low"), ("c", "2", 9, 9, "BND", "PASS")]


def test_sheets_and_optional_tables(spark, write):
    path = write("run.json", '{"samples": {"1": {"sample_name": "a", "donor": "d", "tumor_normal": "tumor"}, "2": {"sample_name": "b"}}, "other": 1}')
    assert rows(readers.sample_sheet(spark, path)) == [("a", "d", "tumor"), ("b", None, None)]
    paths = spark.createDataFrame([("x/s1/a.region_coverage.tsv",)], "p string")
    assert paths.select(readers.snp_path(paths["p"])).first()[0] == "x/s1/a.snpAF.tsv"
    assert readers.tumour_fractions(spark, None).count() == 0 and readers.tumour_fractions(spark, path + ".none").count() == 0
    assert rows(readers.tumour_fractions(spark, write("tc.tsv", "sample\tpred_TL\ts\nx\t0.4\t1\n"))) == [("x", 0.4)]
    table = readers.cohort_table(spark, write("cohort.tsv", "sample\tchr\tstart\tcn_pred\n7\t1\t5\t2\n"))
    assert rows(table) == [("7", "1", 5, "2")]


def test_caller_config(spark):
    bams = spark.createDataFrame([("test", "test.bam"), ("other", "o.bam")], "sample string, bam string")
    sizes = spark.createDataFrame([("test", "200")], "sample string, mean_insert_size string")
    assert [r["value"] for r in sinks.caller_config(bams, sizes).collect()] == ["test.bam\t200\ttest"]


def test_event_kind(spark):
    paths = spark.createDataFrame([("a/x_INV",), ("a/x_TD",), ("a/x.vcf",)], "p string")
    assert [r[0] for r in paths.select(readers.event_kind(paths["p"])).collect()] == ["INV", "TD", None]


def test_freec_calls_of_several_samples(spark, write):
    write("freec/s1/run_CNVs", "1\t100\t5000\t3\tgain\nX\t7\t9\t0\tloss\n")
    path = write("freec/s2/run_CNVs", "2\t1\t2\t1\tloss\n").replace("s2", "*")
    found = readers.freec_calls(spark, path, r"/freec/([^/]+)/")
    assert found.columns[:5] == ["chr", "start", "end", "copy_number", "kind"]
    assert rows(found) == [("1", 100, 5000, 3, "gain", "s1"), ("2", 1, 2, 1, "loss", "s2"), ("X", 7, 9, 0, "loss", "s1")]
