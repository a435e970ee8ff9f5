"""plotweave.streaming"""
