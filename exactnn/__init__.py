"""Exact nearest-neighbour ground truths on Spark."""

from exactnn.operators.knn import knn_join, knn_lists, knn_partials
from exactnn.operators.ranking import merge_topk
from exactnn.plans.ground_truth import Corpus, sentence_ground_truth, token_ground_truth
from exactnn.sources.xvec import read_xvec, write_xvec

__all__ = [
    "Corpus",
    "knn_join",
    "knn_lists",
    "knn_partials",
    "merge_topk",
    "read_xvec",
    "sentence_ground_truth",
    "token_ground_truth",
    "write_xvec",
]
