"""headstart.operators"""
