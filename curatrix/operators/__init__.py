"""curatrix.operators"""
