"""plotweave.functions"""
