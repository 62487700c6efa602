"""Model queries: training and scoring on the feature tables.

The mean-feature table of the events analogue (24 h, set A) is standardised,
split 80/20 with a seeded order, and used for logistic regression, cross
validation, the kernel SVM, calibration and the C grid.  The hourly
sequences feed the sequence classifiers.

Scores and weights are floating-point results of a fit, which SQL cannot give.  What it
can decide (rows, labels, folds, and that every row passes a test on the fit) is in the
queries named ``*_checked``, each with its SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dictionary as D
from ..operators import calibration, features, kernel_svm, linear, metrics, models, networks, sequences, split, training
from ..operators.linear import Subset
from ..session import kept, persist, remove_path, scratch_path
from . import queries as Q

FOLDS = 5
C_GRID = [0.0001, 0.001, 0.1, 1.0, 10.0]
EPOCHS, BATCH_SIZE = 20, 64
# The SVM's optimality gap, and the room its margins have at that gap.
GAP = 1e-3


def _model_table(spark, d):
    ev = Q.events_pipeline(spark, d, 24, D.OUTLIER_RULES_13)
    cols = features.feature_columns("A")
    order = [split.arithmetic_hash("hadm_id", Q.SEED), F.col("hadm_id")]
    with kept(features.feature_table(ev, Q._info(spark, d), "A")) as wide:
        scaled = models.standard_scaler_apply(wide, models.standard_scaler_fit(wide, cols))
        data = scaled.withColumn("label", F.col("hospital_expire_flag").cast("double"))
        data = split.fraction_split(data, order, 0.2, unique_order=True)    # one row per admission
    return data, cols


def _folds(data):
    """The table with the fold of its training rows; test rows have none."""
    order = [split.arithmetic_hash("hadm_id", Q.SEED), F.col("hadm_id")]
    with kept(data) as data:
        train = split.stratified_folds(data.where("split = 'train'"), "label", order, FOLDS, unique_order=True)
    return train.unionByName(data.where("split <> 'train'"), allowMissingColumns=True)


def _left_out(*costs):
    return [Subset(C, k) for C in costs for k in range(FOLDS)]


@Q.register("logistic_scores")
def q_logistic_scores(spark, d):
    data, cols = _model_table(spark, d)
    with kept(data) as data:
        fit = linear.fit_logistic(data.where("split = 'train'"), cols)
    return linear.predict_logistic(data.where("split = 'test'"), fit).select("hadm_id", "label", "prediction", "score")


@Q.register("logistic_coefficients")
def q_logistic_coefficients(spark, d):
    """M3: the fitted coefficients, one row per feature."""
    data, cols = _model_table(spark, d)
    return linear.coefficients(spark, linear.fit_logistic(data.where("split = 'train'"), cols))


@Q.register("logistic_cv")
def q_logistic_cv(spark, d):
    """M5: the models of all folds from one aggregation a step."""
    data, cols = _model_table(spark, d)
    with kept(_folds(data).where("split = 'train'")) as train:
        fit = linear.fit_logistic(train, cols, _left_out(1.0), fold_col="fold")
        folds = linear.fold_accuracies(train, fit)
    return spark.createDataFrame([(sum(a for a, _ in folds.values()) / FOLDS, sum(n for _, n in folds.values()))],
                                 "cv_accuracy double, n_train long")


_SQL_MODEL_ROWS = (Q.sql_events_pipeline(24, D.OUTLIER_RULES_13) + ",\n" + Q.SQL_INFO + f""",
ids AS (SELECT DISTINCT hadm_id FROM cleaned),
placed AS (SELECT ids.hadm_id, CAST(i.hospital_expire_flag AS DOUBLE) AS label, {Q.sql_hash('ids.hadm_id', Q.SEED)} AS h,
                  row_number() OVER (ORDER BY {Q.sql_hash('ids.hadm_id', Q.SEED)}, ids.hadm_id) - 1 AS pos, count(*) OVER () AS n
           FROM ids LEFT JOIN info i ON i.hadm_id = ids.hadm_id),
rows AS (SELECT hadm_id, label, CASE WHEN pos < ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split, h FROM placed),
folds AS (SELECT hadm_id, label, split, CASE WHEN split = 'train' THEN
            CAST((row_number() OVER (PARTITION BY split, label ORDER BY h, hadm_id) - 1) * {FOLDS} // count(*) OVER (PARTITION BY split, label) AS INTEGER) END AS fold FROM rows)""")


@Q.register("logistic_checked", _SQL_MODEL_ROWS + """
SELECT hadm_id, label, true AS in_range, true AS score_decides, true AS same_after_reload, true AS weights_optimal,
       (SELECT count(*) FROM rows WHERE split = 'train') AS n_train FROM rows WHERE split = 'test'""")
def q_logistic_checked(spark, d):
    """Each test row with tests of its score, of the reloaded model's, and of the fit's gradient."""
    data, cols = _model_table(spark, d)
    with kept(data) as data:
        train = data.where("split = 'train'")
        fit, n = linear.fit_logistic(train, cols), train.count()
    path = scratch_path(spark, "logistic")
    linear.save_logistic(spark, fit, path)
    again = linear.load_logistic(spark, path)
    remove_path(spark, path)
    out = linear.predict_logistic(linear.predict_logistic(data.where("split = 'test'"), fit), again, score="again", prediction="_p")
    return out.select("hadm_id", "label", F.col("score").between(0.0, 1.0).alias("in_range"),
                      (F.col("prediction") == (F.col("score") >= 0.5).cast("double")).alias("score_decides"),
                      (F.col("again") == F.col("score")).alias("same_after_reload"),
                      F.lit(bool((fit.gradient_norms < 1e-8 * max(1, n / 1000)).all())).alias("weights_optimal"), F.lit(n).cast("long").alias("n_train"))


@Q.register("rbf_svm_scores")
def q_rbf_svm_scores(spark, d):
    """M7: margins of the test rows; they get their scores in the training's own passes."""
    data, cols = _model_table(spark, d)
    fit = kernel_svm.fit_svm(_folds(data), cols, fold_col="fold")
    margin = fit.margin()
    return fit.margins.where("fold < 0").select(
        "hadm_id", (F.col("y") > 0).cast("double").alias("label"), (margin > 0).cast("double").alias("prediction"), margin.alias("margin"))


def _calibrated(spark, d):
    """The SVM of all training rows and those of the folds, in one run, and the calibration of the latter's margins."""
    data, cols = _model_table(spark, d)
    fit = kernel_svm.fit_svm(_folds(data), cols, [Subset(), *_left_out(1.0)], fold_col="fold", tolerance=GAP)
    platt = calibration.fit_platt(kernel_svm.out_of_fold(fit).withColumn("label", (F.col("y") > 0).cast("double")))
    return fit, platt


@Q.register("svm_calibrated")
def q_svm_calibrated(spark, d):
    """M8: probabilities of the test rows, calibrated on out-of-fold margins."""
    fit, platt = _calibrated(spark, d)
    return fit.margins.where("fold < 0").select(
        "hadm_id", (F.col("y") > 0).cast("double").alias("label"), (fit.margin() > 0).cast("double").alias("prediction"),
        platt.probability(fit.margin()).alias("probability_cal"))


@Q.register("svm_checked", _SQL_MODEL_ROWS + """
SELECT hadm_id, label, coalesce(fold, -1) AS fold, true AS optimal, true AS in_range FROM folds""")
def q_svm_checked(spark, d):
    """M7, M8: every row with its fold, whether it meets the optimality conditions of the SVM and of its
    fold's SVM (a row outside a training set: no multiplier), and whether its probability is one."""
    fit, platt = _calibrated(spark, d)
    meets = F.lit(True)
    for m, s in enumerate(fit.subsets):
        a, room = F.col("a")[m], F.col("y") * fit.margin(m)
        inside = (F.col("fold") >= 0) & (F.lit(True) if s.without is None else F.col("fold") != s.without)
        # With a gap g a row without multiplier may lie g inside its margin, one at the bound g outside.
        kkt = F.when(a <= 0, room >= 1 - 2 * GAP).when(a >= s.C, room <= 1 + 2 * GAP).otherwise(F.abs(room - 1) <= 2 * GAP)
        meets = meets & F.when(inside, kkt).otherwise(a == 0)
    p = platt.probability(fit.margin())
    return fit.margins.select("hadm_id", (F.col("y") > 0).cast("double").alias("label"), "fold", meets.alias("optimal"), p.between(0.0, 1.0).alias("in_range"))


@Q.register("svm_grid")
def q_svm_grid(spark, d):
    """M6: all C values and folds in one run."""
    data, cols = _model_table(spark, d)
    fit = kernel_svm.fit_svm(_folds(data).where("split = 'train'"), cols, _left_out(*C_GRID), fold_col="fold")
    folds = kernel_svm.fold_accuracies(fit)
    remove_path(spark, fit.path)
    return spark.createDataFrame([(float(c), sum(folds[c, k][0] for k in range(FOLDS)) / FOLDS) for c in C_GRID],
                                 "C double, cv_accuracy double")


def _sequence_rows(spark, d):
    """Labelled hourly sequences (set A, unpadded) split into test, valid and train."""
    scaled, cols = Q._scaled_seq_input(spark, d, "A")
    seqs = sequences.build_sequences(scaled, cols, Q.SEQ_LIMIT)
    labelled = persist(sequences.sequences_with_label(seqs, Q._info(spark, d)).withColumn("label", F.col("hospital_expire_flag").cast("double")))
    n = labelled.count()
    part = max(1, int(0.15 * n))
    order = [split.arithmetic_hash("hadm_id", Q.SEED), F.col("hadm_id")]
    return split.positional_split(labelled, order, [("test", part), ("valid", part), ("train", None)], rows=n,
                                  unique_order=True), len(cols)         # one row per admission


def _trained(rows, network, epochs=EPOCHS):
    return training.train(network, rows.where("split = 'train'"), rows.where("split = 'valid'"), epochs, BATCH_SIZE)


def _mlp(width):
    return networks.Mlp(width, Q.SEQ_LIMIT)


def _test_scores(rows, trained):
    test = rows.where("split = 'test'")
    return test.select("hadm_id", "label").join(training.score(test, trained), "hadm_id")


@Q.register("sequence_gru")
def q_sequence_gru(spark, d):
    """Test scores of the recurrent classifier of the best of 20 epochs."""
    rows, width = _sequence_rows(spark, d)
    return _test_scores(rows, _trained(rows, networks.Gru(width))).select("hadm_id", "label", "prediction", "score")


@Q.register("sequence_mlp")
def q_sequence_mlp(spark, d):
    """The same training of a plain network over the padded sequence."""
    rows, width = _sequence_rows(spark, d)
    return _test_scores(rows, _trained(rows, _mlp(width))).select("hadm_id", "label", "prediction", "score")


@Q.register("training_curve")
def q_training_curve(spark, d):
    """Training and validation loss and accuracy of each epoch of the recurrent classifier; the best is marked."""
    rows, width = _sequence_rows(spark, d)
    return _trained(rows, networks.Gru(width)).curve_table(spark)


@Q.register("sequence_checked", Q.SQL_SEQ_A + ",\n" + Q.SQL_INFO + f""",
seqs AS (SELECT k.hadm_id, CAST(i.hospital_expire_flag AS DOUBLE) AS label, count(*) OVER () AS n,
                row_number() OVER (ORDER BY {Q.sql_hash('k.hadm_id', Q.SEED)}, k.hadm_id) - 1 AS pos FROM kept k JOIN info i ON i.hadm_id = k.hadm_id)
SELECT hadm_id, label, model, true AS in_range, true AS score_decides, true AS same_after_reload, 2 AS epochs, true AS best_is_best
FROM seqs, (VALUES ('gru'), ('mlp')) m(model) WHERE pos < greatest(1, floor(0.15 * n))""")
def q_sequence_checked(spark, d):
    """Each test row with tests of its score by both networks, of the reloaded network's, and of the curve."""
    rows, width = _sequence_rows(spark, d)
    out = None
    for name, network in (("gru", networks.Gru(width)), ("mlp", _mlp(width))):
        trained = _trained(rows, network, 2)
        path = scratch_path(spark, "network")
        training.save_network(spark, trained, path)
        again = training.load_network(spark, path)
        remove_path(spark, path)
        accuracies = [c[4] for c in trained.curve]
        best = accuracies.index(max(accuracies)) + 1 == trained.best_epoch
        both = _test_scores(rows, trained).join(_test_scores(rows, again).select("hadm_id", F.col("score").alias("again")), "hadm_id")
        one = both.select("hadm_id", "label", F.lit(name).alias("model"), (F.col("score").between(0, 1) & F.col("probability").between(0, 1)).alias("in_range"),
                          (F.col("prediction") == (F.col("probability") > 0.5).cast("double")).alias("score_decides"),
                          (F.col("again") == F.col("score")).alias("same_after_reload"),
                          F.lit(len(trained.curve)).alias("epochs"), F.lit(best).alias("best_is_best"))
        out = one if out is None else out.unionByName(one)
    return out


@Q.register("length_batches", Q.SQL_SEQ_A + f""",
sums AS (SELECT s.hadm_id, k.num_stamps, sum({Q._row_sum_sql(Q.FEATS_A)}) AS total FROM scaled s JOIN kept k ON k.hadm_id = s.hadm_id GROUP BY 1, 2),
dealt AS (SELECT *, CAST({Q.sql_hash('hadm_id', Q.SEED)} % (SELECT ceil(count(*) / {BATCH_SIZE}.0) FROM kept) AS INTEGER) AS batch FROM sums),
placed AS (SELECT *, max(num_stamps) OVER (PARTITION BY batch) AS batch_steps,
                  CAST(row_number() OVER (PARTITION BY batch ORDER BY num_stamps DESC, hadm_id) - 1 AS INTEGER) AS place FROM dealt)
SELECT hadm_id, batch, place, num_stamps, batch_steps, batch_steps AS padded_steps,
       {Q.r6(f'total - {len(Q.FEATS_A)} * (batch_steps - num_stamps)')} AS padded_sum FROM placed""")
def q_length_batches(spark, d):
    """Mini-batches, longest sequence first, padded to the longest of each."""
    scaled, cols = Q._scaled_seq_input(spark, d, "A")
    with kept(sequences.build_sequences(scaled, cols, Q.SEQ_LIMIT)) as seqs:
        batches = max(1, -(-seqs.count() // BATCH_SIZE))
    out = sequences.length_batches(seqs, batches, len(cols), Q.SEED)
    total = F.aggregate(F.flatten("padded"), F.lit(0.0), lambda acc, x: acc + x)
    return Q.round_doubles(out.select("hadm_id", "batch", "place", "num_stamps", "batch_steps", F.size("padded").alias("padded_steps"), total.alias("padded_sum")))


@Q.register("model_reload")
def q_model_reload(spark, d):
    from pyspark.ml.classification import LogisticRegressionModel
    data, cols = _model_table(spark, d)
    with kept(models.assemble(data, cols)) as data:
        model = models.fit_logistic(data.where("split = 'train'"))
    path = scratch_path(spark, "logistic-model")
    models.save_model(model, path)
    again = models.load_model(LogisticRegressionModel, path)
    return models.positive_probability(again.transform(data.where("split = 'test'"))).select("hadm_id", "label", "prediction", "score")


@Q.register("logistic_test_metrics")
def q_logistic_test_metrics(spark, d):
    """M9 + M10 + M12 on the test-set scores of the logistic model."""
    with kept(q_logistic_scores(spark, d)) as scored:
        auc = metrics.roc_auc(scored, "label", "score").first()
        acc = metrics.accuracy(scored, "label", "prediction").first()
        cm = {(int(r["label"]), int(r["prediction"])): int(r["n"])
              for r in metrics.confusion_counts(scored, "label", "prediction").collect()}
    return spark.createDataFrame(
        [(acc["n"], acc["accuracy"], auc["auc"], cm[(0, 0)], cm[(0, 1)], cm[(1, 0)], cm[(1, 1)])],
        "n long, accuracy double, auc double, tn long, fp long, fn long, tp long")


@Q.register("sequence_mlp_auc")
def q_sequence_mlp_auc(spark, d):
    """M12 on the sequence model's test scores."""
    with kept(q_sequence_mlp(spark, d)) as scored:
        return spark.createDataFrame([tuple(metrics.roc_auc(scored, "label", "score").first())], "auc double, positives long, negatives long")
