"""linclass: penalised linear binary classification on Spark DataFrames.

Load delimited or columnar data, check it, profile it by class, recode labels, drop
columns by name, split train / test by a hash of a key, standardise with train
statistics, fit ridge / lasso / elastic-net logistic regression or a linear SVM (built-in
optimisers or full-batch gradient descent), save and load models, score, and report exact
AUC, balanced accuracy and coefficient tables - all as DataFrame plans.
"""

from linclass.plans.jobs import JobConfig, JobResult, enet_job, logistic_job, ridge_job, run_job, svm_job

__all__ = ["JobConfig", "JobResult", "enet_job", "logistic_job", "ridge_job", "run_job", "svm_job"]
