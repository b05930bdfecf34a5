"""Landed-file readers, predicate trees and test-table projections."""
