"""plotweave.sources"""
