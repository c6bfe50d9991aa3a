"""curatrix.plans"""
