"""plotweave.plans"""
