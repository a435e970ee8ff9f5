"""plotweave.operators"""
